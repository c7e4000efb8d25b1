"""Multi-party chats from every participant's side.

For each participant of a conversation the whole dialogue is rendered with that speaker as
the assistant and all others as named users.  The mask lists what the model learns to say:
the participant's own turns with their end marks, as start:end in characters of the rendered
text.  Speakers in `context` (instructions, not participants) stay what they are and are
nobody's side.

A conversation is rendered in parts of at most `PART` turns, so no row grows without bound.
Turns get their places in the conversation from one range-partitioned sort and the counts of
its partitions; no task ever holds a conversation.

A context turn stands in the part that its place falls in, so instructions at the beginning
are in the first part alone.

What a text or a name says is never a mark.  In texts each `<|` gets a backslash between its
two characters, and where backslashes stand there already (`<\\|`) one more; taking one
away gives the text back.  In names backslashes are doubled, `|` becomes `\\|` and a line feed
`\\n`, so a head is one line.  Masks and lengths count what is rendered.

Only DataFrame functions are used.  Defined cases: turns are ordered by turn (nulls last),
speaker and text; a null text is empty; a null or empty speaker is "unknown"; rows without a
conversation id form one conversation of their own; repeated rows are repeated turns; a
conversation of context turns alone has no participants and no rows; texts are rendered whole;
columns other than the four named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratebook.llm.common import stored

PART = 64
CONTEXT = ("system",)
END = "<|end|>"


def placed(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The rows with `place`: their number in the group, from 0, in the given order.

    One range-partitioned sort numbers the rows of a partition; a group that spans several
    partitions adds the counts of the partitions before.
    """
    numbered = stored(
        rows.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("__n", F.monotonically_increasing_id()),
        "placed",
    ).withColumn("__p", F.shiftright("__n", 33))
    counts = numbered.groupBy(group, "__p").agg(
        F.min("__n").alias("__first"), F.count("*").alias("__rows")
    )
    before = Window.partitionBy(group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("__group"),
        F.col("__p").alias("__q"),
        "__first",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    joined = numbered.join(
        offsets, (F.col("__p") == F.col("__q")) & F.col(group).eqNullSafe(F.col("__group"))
    )
    return joined.withColumn("place", F.col("__n") - F.col("__first") + F.col("__before")).drop(
        "__n", "__p", "__q", "__first", "__before", "__group"
    )


def escaped_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_name(name: Column) -> Column:
    for plain, written in (("\\", r"\\"), ("|", r"\|"), ("\n", r"\n")):
        name = F.replace(name, F.lit(plain), F.lit(written))
    return name


def perspectives(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    part: int = PART,
    context: tuple[str, ...] = CONTEXT,
) -> DataFrame:
    """(conv_id, participant, part, n_turns, rendered, mask, n_masked)."""
    rows = turns.select(
        F.col(f"`{conversation}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.when(F.col(f"`{speaker}`") == "", None)
        .otherwise(F.col(f"`{speaker}`"))
        .alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("speaker", F.coalesce("speaker", F.lit("unknown")))
    rows = placed(
        rows, "conv_id", [F.col("turn").asc_nulls_last(), F.col("speaker"), F.col("text")]
    )
    parts = (
        rows.select(
            "conv_id",
            F.floor(F.col("place") / F.lit(part)).alias("part"),
            F.struct(
                "place",
                "speaker",
                escaped_name(F.col("speaker")).alias("name"),
                escaped_text(F.col("text")).alias("text"),
            ).alias("said"),
        )
        .groupBy("conv_id", "part")
        .agg(F.array_sort(F.collect_list("said")).alias("turns"))
    )
    sides = (
        rows.where(~F.col("speaker").isin(*context) if context else F.lit(True))
        .select(F.col("conv_id").alias("of"), F.col("speaker").alias("participant"))
        .distinct()
    )
    own = F.col("participant")

    def head(t: Column) -> Column:
        named = F.concat(F.lit("<|user:"), t["name"], F.lit("|>\n"))
        if context:
            kept = F.concat(F.lit("<|"), t["name"], F.lit("|>\n"))
            named = F.when(t["speaker"].isin(*context), kept).otherwise(named)
        return F.when(t["speaker"] == own, F.lit("<|assistant|>\n")).otherwise(named)

    said = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"),
            F.concat(t["text"], F.lit(END)).alias("body"),
            (t["speaker"] == own).alias("own"),
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.concat(begin.cast("string"), F.lit(":"), end.cast("string"))
        return F.struct(
            (end + 1).cast("long").alias("at"),
            F.when(t["own"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    return (
        parts.join(sides, F.col("conv_id").eqNullSafe(F.col("of")))
        .withColumn("said", said)
        .select(
            "conv_id",
            "participant",
            F.col("part").cast("long").alias("part"),
            F.size("said").cast("long").alias("n_turns"),
            F.array_join(
                F.transform("said", lambda t: F.concat(t["head"], t["body"], F.lit("\n"))), ""
            ).alias("rendered"),
            F.array_join(F.aggregate("said", start, step)["spans"], ",").alias("mask"),
            F.aggregate(
                "said",
                F.lit(0).cast("long"),
                lambda n, t: n + F.when(t["own"], F.length(t["body"])).otherwise(0).cast("long"),
            ).alias("n_masked"),
        )
    )


#: The same rows on a table `conversations` (conv_id, turn, role, text).
SQL = rf"""
WITH turns AS (
  SELECT conv_id, COALESCE(NULLIF(role, ''), 'unknown') AS speaker, COALESCE(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST,
           COALESCE(NULLIF(role, ''), 'unknown'), COALESCE(text, '')) - 1 AS place
  FROM conversations),
sides AS (SELECT DISTINCT conv_id, speaker AS participant FROM turns WHERE speaker <> 'system'),
said AS (
  SELECT t.conv_id, participant, place // {PART} AS part, place,
         speaker = participant AS own,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '{END}' AS body,
         CASE WHEN speaker = participant THEN '<|assistant|>'
              WHEN speaker = 'system' THEN '<|system|>'
              ELSE '<|user:' || replace(replace(replace(speaker, '\', '\\'), '|', '\|'),
                                        chr(10), '\n') || '|>' END || chr(10) AS head
  FROM turns t JOIN sides s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
measured AS (
  SELECT *, CAST(SUM(length(head) + length(body) + 1)
              OVER (PARTITION BY conv_id, participant, part ORDER BY place)
              - length(body) - 1 AS BIGINT) AS start
  FROM said)
SELECT conv_id, participant, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY place) AS rendered,
       COALESCE(string_agg(CASE WHEN own THEN start || ':' || (start + length(body)) END, ','
         ORDER BY place), '') AS mask,
       CAST(COALESCE(SUM(CASE WHEN own THEN length(body) END), 0) AS BIGINT) AS n_masked
FROM measured GROUP BY conv_id, participant, part
"""
