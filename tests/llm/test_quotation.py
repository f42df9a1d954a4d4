import re
from collections import defaultdict
from itertools import groupby

from gleanwork.llm.quotation import link_messages, op7_quotation_linking, quoting_replies


def linked(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, passage string, level int")
    out = link_messages(frame).orderBy("thread_conv", "thread_turn", "conv_id", "turn").collect()
    return [
        (r.conv_id, r.turn, r.text, r.quotes, r.linked, r.reply_conv, r.reply_turn, r.thread_conv, r.thread_turn, r.reply_depth)
        for r in out
    ]


def row(conv, turn, text):
    return (conv, turn, "user", text, None, None)


def test_nested_quotes_build_a_thread(spark):
    rows = [
        row(1, 0, "Where is\nthe key?\n\nI lost it."),
        row(1, 1, "On Monday Ann wrote:\n> Where is the   KEY?\n\nUnder the mat."),
        row(1, 2, "> > Where is the key?\n> Under the mat.\nThanks."),
        row(1, 3, "Unrelated"),
        row(2, 0, "> under the mat.\nAnother answer\n>> nobody wrote this"),
    ]
    assert linked(spark, rows) == [
        (1, 0, "Where is\nthe key?\n\nI lost it.", 0, 0, None, None, 1, 0, 0),
        (1, 1, "Under the mat.", 1, 1, 1, 0, 1, 0, 1),
        (1, 2, "Thanks.", 2, 2, 1, 1, 1, 0, 2),
        (2, 0, "Another answer", 2, 1, 1, 1, 1, 0, 2),
        (1, 3, "Unrelated", 0, 0, None, None, 1, 3, 0),
    ]


def test_long_chains_end_at_the_first_message(spark):
    rows = [row(1, 0, "message 0")] + [row(1, i, f"> message {i - 1}\nmessage {i}") for i in range(1, 40)]
    out = linked(spark, rows)
    assert [(r[1], r[8], r[9]) for r in out] == [(i, 0, i) for i in range(40)]


def test_parts_of_paragraphs_link(spark):
    rows = [
        row(1, 0, "Where is\nthe key?\n\nI lost it. It was red.\nIt shone"),
        row(1, 1, "> the key?\nUnder the mat."),
        row(1, 2, "> I lost\n> it.\nNo."),
        row(1, 3, "> Where is\n> the key?\n> I lost it. It was red.\n> It shone\nBoth."),
        row(1, 4, "> the key?\n> that a stranger dropped into the deep lake\nMostly not."),
        row(1, 5, "> Under the mat.\n> I lost it. It was red.\nMixed."),
    ]
    got = {r[1]: (r[3], r[4], r[5], r[6]) for r in linked(spark, rows)}
    assert got == {
        0: (0, 0, None, None),
        1: (1, 1, 1, 0),
        2: (1, 1, 1, 0),
        3: (1, 1, 1, 0),
        4: (1, 0, None, None),
        5: (1, 1, 1, 0),
    }


def test_odd_rows(spark):
    rows = [
        row(None, 0, "hello"),
        row(1, None, "> hello"),
        row(1, 0, None),
        row(1, 1, ""),
        row(1, 2, ">\n> \n>>"),
        row(1, 3, "> says itself\n\nsays itself"),
        row(1, 4, "> says itself"),
        row(1, 4, "> says itself"),
    ]
    out = linked(spark, rows)
    assert len(out) == 8
    assert all(r[5] is None for r in out if r[1] != 4)
    assert [(r[5], r[6]) for r in out if r[1] == 4] == [(1, 3), (1, 3)]
    assert linked(spark, []) == []


def test_query_keeps_all_messages(spark):
    frame = op7_quotation_linking(spark, "/root/testdata/sf0.001")
    source = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert frame.select("conv_id", "turn", "role", "text").exceptAll(source).count() == 0
    assert frame.count() == source.count()


def test_short_units_stay_in_their_conversation(spark):
    rows = [
        row(1, 0, "Thanks!\n\nUnder the mat.\n\nHello dear old friend\n\nWe meet in the old harbour on Friday"),
        row(2, 0, "hello dear old friend\n\nwe meet in the old harbour on friday"),
        row(9, 0, "> thanks!\nWelcome"),
        row(9, 1, "> under the mat.\nRare"),
        row(9, 2, "> Hello dear old friend\nOften written"),
        row(9, 3, "> We meet in the old harbour on Friday\nLong"),
        row(9, 4, "> welcome\nOwn"),
    ]
    got = {(r[0], r[1]): (r[5], r[6]) for r in linked(spark, rows)}
    assert [got[9, t] for t in range(5)] == [(None, None), (1, 0), (None, None), (1, 0), (9, 0)]


def brute_links(messages):
    """(conv, turn) to (quotes, linked, parent), by dictionaries."""
    marks = re.compile(r"^((?:[ \t]*>)+)[ \t]?")

    def normal(text):
        return re.sub(r"\s+", " ", text, flags=re.A).strip(" ").lower()

    def sentences(text):
        return re.split(r"(?<=[.!?]) ", text)

    written = defaultdict(dict)
    for conv, turn, text in messages:
        lines = [x for x in text.split("\n") if not marks.match(x) and not re.match(r"On .*wrote:$", x)]
        paragraphs = [normal(x) for x in re.split(r"\n[ \t]*\n", "\n".join(lines).strip())]
        for unit in {*paragraphs, *map(normal, lines), *(x for p in paragraphs for x in sentences(p))} - {""}:
            written[unit][conv] = min(turn, written[unit].get(conv, turn))

    def origin(unit, conv, turn):
        places = written.get(unit, {})
        if places.get(conv, turn) < turn:
            return conv, places[conv]
        words = len(unit.split(" "))
        if places and min(places) < conv and (words >= 5 or words >= 3 and len(places) == 1):
            return min(places), places[min(places)]
        return None

    out = {}
    for conv, turn, text in messages:
        leveled = []
        for line in text.split("\n"):
            found = marks.match(line)
            body = line[found.end() :] if found else line
            leveled.append((found.group().count(">") if found else 0, body.strip(" ") == "", body))
        passages = {}
        for (level, blank), run in groupby(leveled, lambda x: x[:2]):
            lines = [normal(x[2]) for x in run]
            if level and not blank:
                passages[level, normal(" ".join(lines))] = lines
        parents, links = [], 0
        for (level, passage), lines in passages.items():
            best = None
            for whole, units in ((True, [passage]), (False, lines), (False, sentences(passage))):
                held = defaultdict(int)
                for unit in filter(None, units):
                    held[origin(unit, conv, turn)] += len(unit)
                total = sum(held.values())
                best = max([best or (False, 0, None)] + [
                    (whole, n / total, o) for o, n in held.items() if o is not None and 2 * n >= total
                ], key=lambda x: (x[0], x[1], x[2] or (-1, -1)))
            if best[2] is not None:
                links += 1
                parents += [best[2]] if level == 1 else []
        out[conv, turn] = (len(passages), links, max(parents, default=None))
    return out


def test_query_links_the_quotes_of_all_messages(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        source = spark.read.parquet(f"{folder}/conversations.parquet")
        quoting = [(r.conv_id, r.turn, r.text or "") for r in quoting_replies(source).collect()]
        assert len(quoting) == source.count()
        want = brute_links(quoting)
        rows = op7_quotation_linking(spark, folder).collect()
        got = {(r.conv_id, r.turn): r for r in rows}
        assert {
            k: (r.quotes, r.linked, None if r.reply_conv is None else (r.reply_conv, r.reply_turn)) for k, r in got.items()
        } == want
        assert sum(r.linked for r in rows) > len(rows) // 4
        for r in rows:
            place, depth = (r.conv_id, r.turn), 0
            while want[place][2]:
                place, depth = want[place][2], depth + 1
            assert (place, depth) == ((r.thread_conv, r.thread_turn), r.reply_depth)


def test_quotes_of_odd_messages(spark):
    shape = "conv_id long, turn long, role string, text string, answered string"
    rows = [(1, 0, "user", None, "x"), (1, 1, None, "a", "x"), (1, 2, None, "", "x"), (None, 3, "user", "b", "x"), (1, 1, None, "a", "x")]
    out = quoting_replies(spark.createDataFrame(rows, shape))
    assert out.count() == 5
    assert quoting_replies(spark.createDataFrame([], shape)).count() == 0
