"""Entry point for ``spark-submit``."""

from gleanwork.__main__ import main

if __name__ == "__main__":
    main()
