"""Quotation linking for chats and mail threads, with DataFrame functions only (operator 1).

A line's quote level is the number of ``>`` marks before it, with or without blanks between them.  Adjoining lines of
one level are a passage.  Own text is what has level 0, without the
attribution line ("... wrote:") above a quote.

Passages are normalised (case, white space, punctuation at the ends), hashed, and
joined to the messages that said them: whole own texts, their paragraphs, or
single lines; a quoted passage that matches none as a whole is tried by its
paragraphs, then line by line.  The original of a passage is the first message of the conversation
that holds it; failing that, for passages of ``min_passage`` characters (0: all), the
first of any other conversation.  Both are one row per
hash, combined before the shuffle, so a frequent line joins to one row and
never to all its copies.  A message cannot quote itself or, in its
conversation, a later one.

The parent of a message is the latest original of its conversation that it
quotes at its lowest linked level, else the first original elsewhere.  Threads are
followed by pointer doubling to a root turn and a depth; rows come back
range-partitioned and sorted by (conversation, root turn, depth, turn): a reply
follows what it answers, and no conversation has to fit one task.

Defined results: a null or empty text has no quotes and stays as it is; null
conversations and turns are kept, unlinked; repeated rows are linked alike; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsheet.llm.common import keep, partitions

_MARKS = r"^[ \t>]*>[ \t]?"  #: marks and blanks up to the last mark; one class, so a line of many marks needs no recursion
_ATTRIBUTION = r"(?i)^\s*(?:(?:on|am|le|el)\b.*(?:wrote|schrieb|écrit|escribió)|.*(?:wrote|schrieb|a écrit|escribió))\b.*:\s*$"
BRIEF = 8  #: characters below which a part of a passage ("ok") is the last to decide whom a message answers
SALTS = 16  #: parts of a frequent passage's conversations, where the second of them is sought


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def normalised(text: str) -> str:
    """SQL of a passage's normal form."""
    return f"regexp_replace(lower(trim(regexp_replace({text}, '\\\\s+', ' '))), '^[\\\\p{{Punct}} ]+|[\\\\p{{Punct}} ]+$', '')"


def parse(messages: DataFrame) -> DataFrame:
    """Adds own (text without quotes), passages (level, text, in order) and max_level to rows of conv, turn, role, text."""
    lines = messages.withColumn("lines", F.expr("split(text, '\\r?\\n', -1)")).withColumn(
        "levels", F.expr(f"transform(lines, l -> char_length(regexp_replace(regexp_extract(l, {_sql_text(_MARKS)}, 0), '[^>]', '')))"))
    lines = lines.withColumn("max_level", F.coalesce(F.array_max("levels"), F.lit(0)))
    own = """array_join(transform(filter(sequence(0, size(lines) - 1), i -> levels[i] = 0 AND NOT (
        i + 1 < size(lines) AND coalesce(levels[i + 1], 0) > 0 AND lines[i] RLIKE {0})), i -> lines[i]), '\n')""".format(_sql_text(_ATTRIBUTION))
    lines = lines.withColumn("cuts", F.expr("concat(filter(sequence(0, size(lines) - 1), i -> i = 0 OR levels[i] <> levels[i - 1]), array(size(lines)))"))
    passage = f"""transform(filter(sequence(0, size(cuts) - 2), k -> levels[cuts[k]] > 0), k -> struct(levels[cuts[k]] AS level,
        array_join(transform(slice(lines, cuts[k] + 1, cuts[k + 1] - cuts[k]), l -> regexp_replace(l, {_sql_text(_MARKS)}, '')), '\n') AS text))"""
    empty = "cast(array() AS array<struct<level:int,text:string>>)"
    return lines.withColumns({
        "own": F.expr(f"CASE WHEN max_level = 0 THEN text ELSE trim(BOTH '\n' FROM {own}) END"),
        "passages": F.expr(f"CASE WHEN max_level = 0 THEN {empty} ELSE {passage} END")}).drop("lines", "levels", "cuts")


def _hash(text: str) -> Column:
    return F.expr(f"IF(char_length({normalised(text)}) > 0, sha2({normalised(text)}, 256), NULL)")


def _linked(parsed: DataFrame, min_passage: int) -> DataFrame:
    """One row per message that has a linked quote: conv, turn, h (of the text), p_conv, p_turn."""
    def _short(text: str) -> Column:
        length = f"char_length({normalised(text)})"
        return F.expr(f"struct({length} < {int(min_passage)} AS here_only, {length} < {BRIEF} AS brief)")

    quoting = parsed.filter("max_level > 0").select("conv", "turn", F.xxhash64("text").alias("h"), F.posexplode("passages").alias("at", "p"))
    whole = quoting.select("conv", "turn", "h", "at", "p.level", F.lit(0).alias("part"), _hash("p.text").alias("key"), _short("p.text").alias("short"))
    block = quoting.filter("p.text RLIKE '\n[ \t]*\n'").select("conv", "turn", "h", "at", "p.level", F.explode(F.expr("split(p.text, '\n[ \t]*\n')")).alias("t")) \
        .select("conv", "turn", "h", "at", "level", F.lit(1).alias("part"), _hash("t").alias("key"), _short("t").alias("short"))
    single = quoting.filter("p.text LIKE '%\n%'").select("conv", "turn", "h", "at", "p.level", F.explode(F.expr("split(p.text, '\n')")).alias("t")) \
        .select("conv", "turn", "h", "at", "level", F.lit(2).alias("part"), _hash("t").alias("key"), _short("t").alias("short"))
    quoted = keep(whole.unionByName(block).unionByName(single).filter("key IS NOT NULL"), "quoted-passages")
    said = parsed.filter("conv IS NOT NULL AND turn IS NOT NULL").select("conv", "turn", F.explode(F.expr(
        "array_distinct(concat(array(own), split(own, '\n[ \t]*\n'), split(own, '\n')))")).alias("t")) \
        .select("conv", "turn", _hash("t").alias("key")).filter("key IS NOT NULL")
    said = said.join(quoted.select("key").distinct(), "key", "left_semi")
    here = keep(said.groupBy("key", "conv").agg(F.min("turn").alias("turn")), "originals")
    elsewhere = here.groupBy("key").agg(F.min(F.struct("conv", "turn")).alias("o")) \
        .select("key", F.col("o.conv").alias("o_conv"), F.col("o.turn").alias("o_turn"))
    found = quoted.join(here.withColumnRenamed("turn", "here_turn"), ["key", "conv"], "left").join(elsewhere, "key", "left")
    # The first elsewhere may be the own conversation, quoted before it said so; then the next conversation's counts.
    salts = F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt")
    first = found.filter("conv = o_conv AND here_turn >= turn AND NOT short.here_only").select("key", F.col("conv").alias("not_conv")).distinct()
    others = here.withColumn("salt", F.expr(f"cast(pmod(xxhash64(conv), {SALTS}) AS int)")).join(first.select("key", "not_conv", salts), ["key", "salt"]) \
        .filter("conv <> not_conv").groupBy("key", "salt").agg(F.min(F.struct("conv", "turn")).alias("o"))
    others = others.groupBy("key").agg(F.min("o").alias("o")).select("key", F.col("o.conv").alias("n_conv"), F.col("o.turn").alias("n_turn"))
    found = found.join(others, "key", "left")
    same = F.coalesce(F.col("conv") == F.col("o_conv"), F.lit(False))
    found = found.withColumns({"o_conv": F.when(same, F.col("n_conv")).otherwise(F.col("o_conv")), "o_turn": F.when(same, F.col("n_turn")).otherwise(F.col("o_turn"))})
    own = F.coalesce(F.col("here_turn") < F.col("turn"), F.lit(False))
    other = ~own & F.col("o_turn").isNotNull() & ~F.col("short.here_only")
    found = found.withColumns({"p_conv": F.when(own, F.col("conv")).when(other, F.col("o_conv")),
                               "p_turn": F.when(own, F.col("here_turn")).when(other, F.col("o_turn"))}).filter("p_turn IS NOT NULL")
    # Lowest level first, whole passages before paragraphs before lines, short parts last, this conversation before others, its latest turn, then the first elsewhere.
    rank = F.struct("level", F.when((F.col("part") > 0) & F.col("short.brief"), 3).otherwise(F.col("part")).alias("part"), (F.col("p_conv") != F.col("conv")).alias("away"),
                    F.when(F.col("p_conv") == F.col("conv"), -F.col("p_turn")).otherwise(0).alias("late"), "p_conv", "p_turn")
    return found.groupBy("conv", "turn", "h").agg(F.min(rank).alias("best"), F.countDistinct("at").alias("n_linked")) \
        .select("conv", "turn", "h", "best.p_conv", "best.p_turn", "n_linked")


def _threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root_turn, depth) of every turn with a parent in its conversation, by pointer doubling."""
    jump = keep(links.filter("p_conv = conv").groupBy("conv", "turn").agg(F.max("p_turn").alias("up"))
                .withColumn("depth", F.lit(1).cast("long")), "threads")
    while True:
        above = jump.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = keep(jump.join(above, ["conv", "up"], "left"), "threads")
        jump = moved.select("conv", "turn", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        if moved.filter("next IS NOT NULL").isEmpty():
            return jump.withColumnRenamed("up", "root_turn")


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
         min_passage: int = 0) -> DataFrame:
    """conv, turn, role, text (without quotes), max_level, n_passages, n_linked, parent_conv, parent_turn, root_turn, depth,
    in reply order."""
    spark = messages.sparkSession
    parsed = parse(messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")))
    links = keep(_linked(parsed, min_passage), "quote-links")
    rows = parsed.withColumn("h", F.xxhash64("text")).join(links, ["conv", "turn", "h"], "left")
    rows = rows.join(_threads(links), ["conv", "turn"], "left")
    out = rows.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), F.col("own").alias(text_col), "max_level",
        F.size("passages").alias("n_passages"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("p_conv").alias("parent_conv"),
        F.col("p_turn").alias("parent_turn"), F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"))
    order = [conv_col, "root_turn", "depth", turn_col, role_col, text_col]
    return out.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
