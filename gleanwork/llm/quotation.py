"""Chat formatting by quotation linking.

Lines that begin with ``>`` are quotes, one level per mark. What stands together on a level is a passage;
passages are normalised (marks off, white space to one blank, lower case) and hashed, and so are their lines
and sentences and the paragraphs, lines and sentences that a message wrote itself. Such a unit belongs to
the message that wrote it first: in the same conversation before the quoting message, or else in another one
before it by (conversation, turn), as ids of conversations are taken to follow the time. What stands in another
conversation is only taken for the origin of long units (``FAR_WORDS`` words), or of shorter ones
(``RARE_WORDS``) that one conversation alone holds: everybody writes "thanks!". A passage that nobody wrote as one
unit belongs to the message that wrote at least half of it in lines or in sentences, the most of all. Parts of a
line or sentence are not found. A message replies to the latest message that it quotes on level 1, and threads
follow these replies up to a message that replies to none.

Units are joined by a hash of 128 bits, so no text of a unit is shuffled, and only those that some message quotes
go on (a semi join). First writers are found by minima that are taken before the shuffle, so a unit in very many
messages makes no pairs among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanwork.llm.common import table
from gleanwork.workspace import materialise

MARKS = r"^((?:[ \t]*>)+)[ \t]?"
ATTRIBUTION = r"^[ \t]*(On|Am|Le|El) .*(wrote|schrieb|écrit|escribió)[^:\n]*:[ \t]*$"
SENTENCES = r"(?<=[.!?]) "
WHOLE, LINE, SENTENCE = 0, 1, 2
#: Words of a unit that links to another conversation, and of one that does if no third conversation holds it.
FAR_WORDS = 5
RARE_WORDS = 3


def unit_mark(unit: Column) -> Column:
    return F.unhex(F.md5(unit.cast("binary")))


def normal_passage(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _quoted_passages(quoting: DataFrame) -> DataFrame:
    """``conv_id, turn, level, quote, passage, lines``: runs of quoted lines on one level; blank lines part
    passages. ``quote`` is the mark of the passage and stands for it in later joins.
    """
    # The number is given before the split: beside it each line would get one.
    numbered_messages = quoting.select("conv_id", "turn", "body", F.monotonically_increasing_id().alias("message"))
    lines = numbered_messages.select(
        "conv_id", "turn", "message", F.posexplode(F.split("body", "\n")).alias("at", "line")
    ).select(
        "conv_id",
        "turn",
        "message",
        "at",
        F.length(F.regexp_replace(F.regexp_extract("line", MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace("line", MARKS, "").alias("body"),
    )
    along = Window.partitionBy("message").orderBy("at")
    blank = F.trim("body") == ""
    starts = F.coalesce((F.lag("level").over(along) != F.col("level")) | blank | F.lag(blank).over(along), F.lit(True))
    numbered = lines.select("*", starts.cast("int").alias("starts")).select(
        "*", F.sum("starts").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("run")
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "body")))
    return (
        numbered.where("level > 0")
        .groupBy("message", "run", "conv_id", "turn", "level")
        .agg(F.transform(ordered, lambda x: normal_passage(x["body"])).alias("lines"))
        .select("conv_id", "turn", "level", normal_passage(F.array_join("lines", " ")).alias("passage"), "lines")
        .where("passage <> ''")
        .groupBy("conv_id", "turn", "level", unit_mark(F.col("passage")).alias("quote"))
        .agg(F.max(F.struct("passage", "lines")).alias("held"))
        .select("conv_id", "turn", "level", "quote", "held.*")
    )


def unquoted(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them."""
    own = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(MARKS) & ~line.rlike(ATTRIBUTION))
    return F.when(text.rlike(r"(?m)^[ \t]*>"), F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")).otherwise(text)


def _own_units(own: Column) -> Column:
    """Paragraphs, lines and sentences of a text without quotes, each once."""
    paragraphs = F.transform(F.split(own, r"\n[ \t]*\n"), normal_passage)
    lines = F.transform(F.split(own, "\n"), normal_passage)
    sentences = F.flatten(F.transform(paragraphs, lambda text: F.split(text, SENTENCES)))
    return F.array_distinct(F.concat(paragraphs, lines, sentences))


def _quoted_units() -> Column:
    def units(kind, texts):
        return F.transform(texts, lambda text: F.struct(F.lit(kind).alias("kind"), text.alias("unit")))

    passage = F.col("passage")
    return F.concat(units(WHOLE, F.array(passage)), units(LINE, F.col("lines")), units(SENTENCE, F.split(passage, SENTENCES)))


def link_messages(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    far_words: int = FAR_WORDS,
    rare_words: int = RARE_WORDS,
) -> DataFrame:
    """One row per message: ``conv_id, turn, role, text`` (without quotes), ``quotes, linked, reply_conv,
    reply_turn, thread_conv, thread_turn, reply_depth``.

    In order of (thread_conv, thread_turn, conv_id, turn) every message stands after the one it replies to.
    A message without linked quotes heads its own thread. Null texts are empty; a null conversation or turn
    links to nothing and nothing links to it. Repeated messages (same conversation and turn) are formatted
    one by one and get the links of all of them together. An empty table gives no rows.
    """
    rows = messages.select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    placed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    quoting = placed.where(F.col("body").rlike(r"(?m)^[ \t]*>"))
    quotes = materialise(_quoted_passages(quoting), "chat-quotes")
    passage = ["conv_id", "turn", "level", "quote"]
    parts = (
        quotes.select(*passage, F.explode(_quoted_units()).alias("part"))
        .where("part.unit <> ''")
        .select(
            *passage,
            "part.kind",
            F.length("part.unit").alias("size"),
            F.size(F.split("part.unit", " ")).alias("words"),
            unit_mark(F.col("part.unit")).alias("mark"),
        )
    )
    written = (
        placed.select("conv_id", "turn", unquoted(F.col("body")).alias("own"))
        .select("conv_id", "turn", F.explode(_own_units(F.col("own"))).alias("unit"))
        .where("unit <> ''")
        .select("conv_id", "turn", unit_mark(F.col("unit")).alias("mark"))
        .join(parts.select("mark").distinct(), "mark", "left_semi")
    )
    origins = materialise(written.groupBy("mark", "conv_id").agg(F.min("turn").alias("turn")), "chat-origins")
    first = origins.groupBy("mark").agg(
        F.min(F.struct("conv_id", "turn")).alias("first"), F.count(F.lit(1)).alias("conversations")
    )
    own = origins.select("mark", "conv_id", F.col("turn").alias("own_turn"))
    tells = (F.col("words") >= far_words) | ((F.col("words") >= rare_words) & (F.col("conversations") == 1))
    placed_parts = (
        parts.join(own, ["mark", "conv_id"], "left")
        .join(first, "mark", "left")
        .select(
            *passage,
            "kind",
            "size",
            F.when(F.col("own_turn") < F.col("turn"), F.struct("conv_id", F.col("own_turn").alias("turn")))
            .when((F.col("first.conv_id") < F.col("conv_id")) & tells, F.col("first"))
            .alias("origin"),
        )
    )
    # Line breaks and blanks between units are no one's: shares are of what the units hold.
    held = Window.partitionBy(*passage, "kind")
    writers = (
        placed_parts.groupBy(*passage, "kind", "origin")
        .agg(F.sum("size").alias("size"))
        .withColumn("share", F.col("size") / F.sum("size").over(held))
        .where("origin IS NOT NULL AND share >= 0.5")
        .groupBy(*passage)
        .agg(F.max(F.struct(F.col("kind") == WHOLE, "share", "origin")).getField("origin").alias("origin"))
    )
    found = quotes.select(*passage).join(writers, passage, "left")
    replies = materialise(
        found.groupBy("conv_id", "turn").agg(
            F.count(F.lit(1)).alias("quotes"),
            F.count("origin").alias("linked"),
            F.max(F.when(F.col("level") == 1, F.col("origin"))).alias("parent"),
        ),
        "chat-replies",
    )
    threads = _threads(replies.where("parent IS NOT NULL").select(F.struct("conv_id", "turn").alias("node"), "parent"))
    linked = replies.join(
        threads.select("node.conv_id", "node.turn", "root", "depth"), ["conv_id", "turn"], "left"
    ).withColumnsRenamed({"conv_id": "reply_to_conv", "turn": "reply_to_turn"})
    joined = rows.join(
        linked, (F.col("conv_id") == F.col("reply_to_conv")) & (F.col("turn") == F.col("reply_to_turn")), "left"
    )
    return joined.select(
        "conv_id",
        "turn",
        "role",
        unquoted(F.col("body")).alias("text"),
        F.coalesce("quotes", F.lit(0)).alias("quotes"),
        F.coalesce("linked", F.lit(0)).alias("linked"),
        F.col("parent.conv_id").alias("reply_conv"),
        F.col("parent.turn").alias("reply_turn"),
        F.coalesce("root.conv_id", "conv_id").alias("thread_conv"),
        F.when(F.col("root").isNotNull(), F.col("root.turn")).otherwise(F.col("turn")).alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("reply_depth"),
    )


def _threads(parents: DataFrame) -> DataFrame:
    """``node, root, depth``: each step doubles how far a node looks up, until all look at a root."""
    state = materialise(parents.select("node", F.col("parent").alias("root"), F.lit(1).alias("depth")), "chat-threads")
    while True:
        above = state.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        if state.join(above, "root", "left_semi").isEmpty():
            return state
        state = materialise(
            state.join(above, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "chat-threads",
        )


def quoting_replies(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``: each message as a mail that quotes what it answers.

    By a hash of its place a message quotes all of the message before it (with the first line of the one before
    that, one level deeper), its first line, its last sentence, or nothing. Messages meet by (conversation, turn),
    so a long conversation is no task of its own. Null and empty texts are not quoted, nor is a null place; of
    repeated messages one is.
    """
    messages = messages.select("conv_id", "turn", "role", "text")
    said = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL AND text <> ''").groupBy("conv_id", "turn")
    before = said.agg(F.min("text").alias("answered"))
    earlier = before.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("answered").alias("root"))
    before = before.select("conv_id", (F.col("turn") + 1).alias("turn"), "answered")
    choice = F.pmod(F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")), F.lit(4))

    def marked(mark, text):
        return F.concat(F.lit(mark), F.replace(text, F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))

    announced = F.concat(F.lit("On Monday "), F.coalesce("role", F.lit("somebody")), F.lit(" wrote:\n"))
    nested = F.coalesce(marked("> > ", F.substring_index("root", "\n", 1)), F.lit(""))
    last_sentence = F.element_at(F.split(normal_passage(F.col("answered")), SENTENCES), -1)
    quote = (
        F.when(choice == 0, F.concat(announced, nested, marked("> ", F.col("answered"))))
        .when(choice == 1, marked("> ", F.substring_index("answered", "\n", 1)))
        .when(choice == 2, marked(">", last_sentence))
    )
    joined = messages.join(before, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
    return joined.select("conv_id", "turn", "role", F.coalesce(F.concat(quote, F.coalesce("text", F.lit(""))), "text").alias("text"))


def op7_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of the table hold no quotes: they get them first, and linking takes them off again."""
    return link_messages(materialise(quoting_replies(table(spark, sf_dir, "conversations")), "chat-messages"))


BOOK = {"op7_quotation_linking": (op7_quotation_linking, None)}
