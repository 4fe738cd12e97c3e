"""Reply-ordered conversations from messages that quote one another, in DataFrame operations only.

Quote levels are the ``>`` marks that begin a line. A run of lines of one level is a quoted passage. The
passage as a whole, its paragraphs and its lines are normalised (lower case, single spaces) and
hashed, and joined to the first earlier message of the conversation that holds one of them as its own
text. A message replies to the latest message among the origins of its shallowest linked passages,
and without one to the message before it. A message that replies to another than the one before
it begins a branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
ATTRIBUTION = r"(?i)\b(wrote|writes|said):[ \t]*$"
#: Turns of a conversation that one window orders; what it needs of earlier turns comes from their blocks.
BLOCK_TURNS = 1024
MESSAGE = ["conv_id", "turn", "message"]


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """Messages with their ``lines``, without marks, and ``levels``; ``own`` says which lines are not quoted."""
    lines = F.split(F.coalesce("text", F.lit("")), r"\r?\n")
    marks = lambda line: F.regexp_extract(line, MARKS, 1)
    parsed = messages.withColumn("raw", lines)
    parsed = parsed.withColumn("levels", F.transform("raw", lambda x: F.length(F.regexp_replace(marks(x), "[^>]", ""))))
    parsed = parsed.withColumn("lines", F.transform("raw", lambda x: F.regexp_replace(x, MARKS, "")))
    quoted_next = lambda i: F.coalesce(F.get("levels", i + 1), F.lit(0)) > 0
    own = F.transform("lines", lambda x, i: (F.get("levels", i) == 0) & ~(x.rlike(ATTRIBUTION) & quoted_next(i)))
    return parsed.drop("raw").withColumn("own", own)


def _own_text(parsed: DataFrame) -> DataFrame:
    """The text without quotes, and without blank lines at its ends."""
    kept = F.filter("lines", lambda x, i: F.get("own", i))
    return parsed.withColumn("own_text", F.regexp_replace(F.array_join(kept, "\n"), r"^(?:[ \t]*\n)+|\s+$", ""))


def _units(text: str) -> Column:
    """(rank, hash) of a text as a whole, of its paragraphs and of its lines, the empty ones left out."""
    ranked = [F.array(F.col(text)), F.split(text, r"\n[ \t]*\n"), F.split(text, r"\n")]
    units = F.concat(
        *[F.transform(x, lambda u, r=r: F.struct(F.lit(r).alias("rank"), _normal(u).alias("unit"))) for r, x in enumerate(ranked)]
    )
    filled = F.filter(units, lambda u: u["unit"] != "")
    return F.transform(filled, lambda u: F.struct(u["rank"].alias("rank"), F.md5(u["unit"]).alias("hash")))


def _passages(parsed: DataFrame) -> DataFrame:
    """One row for each quoted passage: its level, first line and text."""
    lines = parsed.where(F.exists("levels", lambda n: n > 0))
    lines = lines.select(*MESSAGE, F.posexplode(F.arrays_zip("levels", "lines")).alias("at", "line"))
    lines = lines.select(*MESSAGE, "at", "line.levels", "line.lines").where("levels > 0")
    run = Window.partitionBy(*MESSAGE, "levels").orderBy("at")
    lines = lines.dropDuplicates([*MESSAGE, "at"]).withColumn("run", F.col("at") - F.row_number().over(run))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "lines"))), lambda x: x["lines"]), "\n")
    return lines.groupBy(*MESSAGE, "levels", "run").agg(F.min("at").alias("at"), text.alias("passage"))


def _before(turns: DataFrame, value: str, staging: Staging) -> DataFrame:
    """``turns`` (conv_id, turn, one row each) with ``so_far``, the largest ``value`` of earlier turns."""
    turns = staging.write(turns.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)), "turns")
    blocks = turns.groupBy("conv_id", "block").agg(F.max(value).alias("most"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = staging.write(blocks.withColumn("most", F.max("most").over(earlier)), "blocks")
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    here = turns.withColumn("here", F.max(value).over(within)).join(blocks, ["conv_id", "block"])
    return here.withColumn("so_far", F.greatest("here", "most")).drop("here", "most", "block")


def _paths(branches: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id``, ``branch``, ``path`` of branches given with ``parent_branch`` and ``reply_to``.

    A path has a step (-reply_to, branch) for each branch from the first on. Sorted by path and turn, a
    branch is followed by the branches that reply to it, those to later messages first. Each round
    puts the path up to where a branch's path begins in front of it, so paths double and branches nested
    n deep take log2(n) rounds.
    """
    none = F.array().cast("array<struct<back: bigint, branch: bigint>>")
    step = F.array(F.struct((-F.col("reply_to")).alias("back"), F.col("branch").alias("branch")))
    own = F.when(F.col("parent_branch").isNull(), none).otherwise(step)
    paths = staging.write(branches.select("conv_id", "branch", F.col("parent_branch").alias("up"), own.alias("path")), "paths")
    while not paths.where("up IS NOT NULL").isEmpty():
        above = paths.select("conv_id", F.col("branch").alias("up"), F.col("path").alias("before"), F.col("up").alias("further"))
        longer = paths.join(above, ["conv_id", "up"], "left")
        path = F.concat(F.coalesce("before", none), "path")
        paths = staging.write(longer.select("conv_id", "branch", F.col("further").alias("up"), path.alias("path")), "paths")
    return paths.drop("up")


def reply_conversations(messages: DataFrame) -> DataFrame:
    """Messages in reply order, without quotes: one row per row of ``messages`` (conv_id, turn, role, text).

    Columns: conv_id, turn, role, text (without quoted lines and the lines that announce them),
    reply_to (turn), branch (turn of the message that begins it), path (to sort by), n_quotes and
    n_linked (quoted passages, and those whose origin was found). Rows are sorted by conv_id,
    path and turn, over all partitions; other columns are ignored.

    A null text stays null and quotes nothing. A message without conv_id or turn replies to nothing and
    is nobody's origin. Messages that share a turn share reply_to and branch (the latest origin of the
    shallowest linked passage of any); repeated rows stay. An empty table gives an empty result.
    """
    staging = Staging(messages.sparkSession, "quotes")
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        F.xxhash64("conv_id", "turn", "role", "text").alias("message"),
    )
    parsed = staging.write(_own_text(_parsed(rows)).select(*MESSAGE, "role", "text", "own_text", "levels", "lines"), "parsed")
    placed = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")

    passages = staging.write(_passages(placed), "passages")
    units = passages.select(*MESSAGE, "levels", "at", F.explode(_units("passage")).alias("u")).select("*", "u.*").drop("u")
    # the index holds units that some passage of the conversation quotes; copies collapse before the shuffle
    wanted = staging.write(units.select("conv_id", "hash").distinct(), "wanted")
    index = placed.select("conv_id", "turn", F.explode(_units("own_text")).alias("u")).select("conv_id", "turn", "u.hash")
    index = index.join(wanted, ["conv_id", "hash"], "left_semi")
    index = staging.write(index.groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")), "index")
    linked = units.join(index, ["conv_id", "hash"]).where("origin < turn")
    linked = linked.groupBy(*MESSAGE, "levels", "at").agg(F.min(F.struct("rank", "origin")).alias("best"))
    linked = staging.write(linked.select(*MESSAGE, "levels", "at", "best.origin"), "linked")

    # shallowest level first, then the latest origin
    replies = linked.groupBy("conv_id", "turn").agg(F.min(F.struct("levels", (-F.col("origin")).alias("back"))).alias("r"))
    replies = staging.write(replies.select("conv_id", "turn", (-F.col("r.back")).alias("quoted")), "replies")
    turns = placed.select("conv_id", "turn").distinct().join(replies, ["conv_id", "turn"], "left")
    turns = _before(turns, "turn", staging).withColumnRenamed("so_far", "previous")
    head = F.col("previous").isNull() | (F.coalesce("quoted", "previous") != F.col("previous"))
    turns = turns.withColumn("reply_to", F.coalesce("quoted", "previous")).withColumn("head", F.when(head, F.col("turn")))
    turns = _before(turns.drop("quoted", "previous"), "head", staging)
    turns = staging.write(turns.select("conv_id", "turn", "reply_to", F.coalesce("head", "so_far").alias("branch")), "placed")

    branch_of = turns.select("conv_id", F.col("turn").alias("reply_to"), F.col("branch").alias("parent_branch"))
    branches = turns.where("turn = branch").join(branch_of, ["conv_id", "reply_to"], "left")
    branches = staging.write(branches.select("conv_id", "branch", "reply_to", "parent_branch"), "branches")
    turns = turns.join(_paths(branches, staging), ["conv_id", "branch"])
    turns = staging.write(turns.select("conv_id", "turn", "reply_to", "branch", "path"), "paths")

    quotes = passages.groupBy("message").agg(F.count("*").alias("n_quotes"))
    quotes = quotes.join(linked.groupBy("message").agg(F.count("*").alias("n_linked")), "message", "left")
    out = parsed.select("conv_id", "turn", "message", "role", F.when(F.col("text").isNotNull(), F.col("own_text")).alias("text"))
    out = out.join(turns, ["conv_id", "turn"], "left").join(staging.write(quotes, "quotes"), "message", "left")
    zero = F.lit(0).cast("long")
    out = out.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "reply_to",
        "branch",
        "path",
        F.coalesce("n_quotes", zero).alias("n_quotes"),
        F.coalesce("n_linked", zero).alias("n_linked"),
    )
    return out.orderBy("conv_id", "path", "turn", "role", "text")
