"""The jobs: each composes sources, operators and sinks into one set-oriented run."""

from gleanwork.plans.documents import document_text, documents_view, run_documents
from gleanwork.plans.images import images_text, run_images
from gleanwork.plans.landing import landed_objects, run_landing
from gleanwork.plans.payloads import run_payloads, run_requests
from gleanwork.plans.sheets import finished_sheets, run_sheets, run_workbooks, workbook_sheets

__all__ = [
    "document_text",
    "documents_view",
    "finished_sheets",
    "landed_objects",
    "run_documents",
    "images_text",
    "run_images",
    "run_landing",
    "run_payloads",
    "run_requests",
    "run_sheets",
    "run_workbooks",
    "workbook_sheets",
]
