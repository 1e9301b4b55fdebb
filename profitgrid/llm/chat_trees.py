"""Operator 8: chat formatting of reply trees. Built-in functions only.

Messages point to the message they answer. Self-joins double, round by round, how far up the tree a message
sees: after k rounds it knows the message 2^k above it and the sum of the scores in between, so the sum of every
path from a leaf to its root takes log(depth) rounds and one row per message. Leaves are then ranked within
their tree, and only the chosen branches are listed, by the same jumps. Only message names and scores travel in
these rounds; each is written to the shared folder. Each chosen path becomes one conversation in one string:

    ### role:\\ntext</turn>\\n

Inside roles and texts a backslash is doubled, and one is put into the control strings ``</turn>``, ``### ``
and (roles) ``:`` before a line end, so that none of them stands there as written and removing the
backslashes restores the text. ``turns`` holds, for each turn, where it begins in the string and where the
text under the loss mask begins and ends (NULL for other roles), in code points.

Defined cases: a NULL text or role is empty; rows of a conversation are ordered by turn, then role, then
text, so ties and repeated rows are turns in a fixed order; NULL is a conv_id like any other; an answer to
a message that does not exist starts a tree; messages whose ancestors form a ring are on no path; of
branches with equal scores the one with the smaller leaf name wins; other columns are not looked at; an
empty table gives an empty result. One conversation is one string, hence in one task, as it must be.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from profitgrid.llm.common import stored, table, whole_text

END = "</turn>\n"
HEAD = "### "
LEARNED = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("### "), F.lit("#\\## "))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":\n"), F.lit(":\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def jumps(messages: DataFrame) -> list[DataFrame]:
    """Rounds of (node, above, total): the message 2^k above a message in round k, NULL beyond the root, and the
    sum of the scores from the message up to that one, which is left out. ``messages`` has (tree, node, parent,
    score); node names are unique. A round has only messages whose path had not ended in the one before, so a few
    long trees do not make the others' messages take part again."""
    known = messages.select(F.col("node").alias("parent"))
    links = messages.join(known, "parent", "left_semi").select("node", F.col("parent").alias("above"))
    score = F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("total")
    rounds = [stored(messages.select("node", score).join(links, "node", "left").select("node", "above", "total"))]
    reach, most = 1, messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    # a ring never ends, but no path is longer than its tree is large
    while reach < most and rounds[-1].where(F.col("above").isNotNull()).head(1):
        now = rounds[-1].where(F.col("above").isNotNull())
        known = now.unionByName(ended(rounds))
        next_ = known.select(F.col("node").alias("above"), F.col("above").alias("top"), F.col("total").alias("more"))
        farther = now.join(next_, "above")
        total = F.col("total") + F.col("more")
        rounds.append(stored(farther.select("node", F.col("top").alias("above"), total.alias("total"))))
        reach *= 2
    return rounds


def ended(rounds: list[DataFrame]) -> DataFrame:
    """The messages whose path has a root, each from the round in which it ended, with the sum of the whole path."""
    return reduce(DataFrame.unionByName, [r.where(F.col("above").isNull()) for r in rounds])


def leaves(messages: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(tree, leaf, score): the messages that no other answers and whose path has a root, with the path's score."""
    answered = rounds[0].where(F.col("above").isNotNull()).select(F.col("above").alias("node"))
    last = ended(rounds).join(answered, "node", "left_anti")
    named = messages.select("tree", "node").join(last.select("node", "total"), "node")
    return named.select("tree", F.col("node").alias("leaf"), F.col("total").alias("score"))


def listed(chosen: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(leaf, node, up) for each leaf of ``chosen`` and each message on its way to the root, ``up`` steps above."""
    found = stored(chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("up")))
    for k, jump in enumerate(rounds):
        farther = found.join(jump.where(F.col("above").isNotNull()), "node")
        found = stored(found.union(farther.select("leaf", F.col("above").alias("node"), F.col("up") + (1 << k))))
    return found


def paths(messages: DataFrame) -> DataFrame:
    """(leaf, node, up) of all branches."""
    rounds = jumps(messages)
    return listed(leaves(messages, rounds).select("leaf"), rounds)


def branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(leaf, node, up) of the ``keep`` best branches of each tree; messages: (tree, node, parent, score)."""
    rounds = jumps(messages)
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    ranked = leaves(messages, rounds).withColumn("place", F.row_number().over(best))
    return listed(ranked.where(F.col("place") <= keep).select("leaf"), rounds)


def formatted(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(conv_id, leaf, formatted, turns): one string for each chosen branch.

    ``messages``: (tree, node, parent, score, conv_id, role, text).
    """
    said = messages.select("node", "conv_id", whole_text("role").alias("role"), whole_text("text").alias("text"))
    rows = branches(messages, keep).join(said, "node")
    head = F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(":\n"))
    rows = rows.withColumn("block", F.concat(head, escape(F.col("text")), F.lit(END)))
    order = Window.partitionBy("leaf").orderBy(F.desc("up"))
    before = F.sum(F.char_length("block")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("begin", F.coalesce(before, F.lit(0).cast("bigint")))
    learned = F.col("role") == LEARNED
    turn = F.struct(
        "begin",
        F.when(learned, F.col("begin") + F.char_length(head)).alias("loss_begin"),
        F.when(learned, F.col("begin") + F.char_length("block") - len(END)).alias("loss_end"),
        "block",
    )
    turns = rows.groupBy("leaf").agg(
        F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns")
    )
    return turns.select(
        "conv_id",
        "leaf",
        F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
        F.transform("turns", lambda t: t.dropFields("block")).alias("turns"),
    )


def read_back(conversations: DataFrame, *more: str) -> DataFrame:
    """(conv_id, formatted, said, learned): roles and texts, and the text under the loss mask turn by turn.
    ``more`` names columns to keep."""
    blocks = F.split("formatted", END, -1)
    pieces = F.zip_with(
        F.slice(blocks, 1, F.size(blocks) - 1),
        F.col("turns"),
        lambda block, turn: F.struct(
            block.alias("block"),
            F.instr(block, F.lit(":\n")).alias("cut"),
            (turn["loss_begin"] - turn["begin"] + 1).cast("int").alias("at"),
            (turn["loss_end"] - turn["loss_begin"]).cast("int").alias("length"),
        ),
    )
    rows = conversations.select("conv_id", "formatted", *more, pieces.alias("pieces"))
    said = F.transform(
        "pieces",
        lambda p: F.struct(
            unescape(p["block"].substr(F.lit(len(HEAD) + 1), p["cut"] - (len(HEAD) + 1))).alias("role"),
            unescape(p["block"].substr(p["cut"] + 2, F.char_length(p["block"]))).alias("text"),
        ),
    )
    under = F.filter("pieces", lambda p: p["at"].isNotNull())
    learned = F.transform(under, lambda p: unescape(p["block"].substr(p["at"], p["length"])))
    return rows.select("conv_id", "formatted", *more, said.alias("said"), learned.alias("learned"))


def as_chains(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees: each row answers the row before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.withColumn("number", F.row_number().over(order))
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    name = F.concat_ws("/", tree, F.lpad(F.col("number").cast("string"), 12, "0"))
    parent = F.when(F.col("number") > 1, F.concat_ws("/", tree, F.lpad((F.col("number") - 1).cast("string"), 12, "0")))
    return rows.select(
        tree.alias("tree"), name.alias("node"), parent.alias("parent"), F.lit(0.0).alias("score"), "conv_id", "role", "text"
    )


def digests(conversations: DataFrame) -> DataFrame:
    """Digests of what ``read_back`` finds in the formatted conversations."""
    read = read_back(conversations)
    turns = F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("said").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def as_replies(conversations: DataFrame) -> DataFrame:
    """Conversations as trees with branches: turn t answers turn (t - 1) div 2, so each has up to two answers.
    Of rows with the same turn the first by role and text counts. A message's score is the length of its text
    modulo 97."""
    first = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.where(F.col("turn") >= 0).withColumn("place", F.row_number().over(first)).where("place = 1")
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))

    def name(turn: Column) -> Column:
        return F.concat_ws("/", tree, F.lpad(turn.cast("string"), 12, "0"))

    parent = F.when(F.col("turn") > 0, name(F.expr("(turn - 1) div 2")))
    score = (F.char_length(whole_text()) % 97).cast("double")
    return rows.select(
        tree.alias("tree"), name(F.col("turn")).alias("node"), parent.alias("parent"), score.alias("score"), "conv_id", "role", "text"
    )


def op8_reply_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best branches of each conversation's reply tree, formatted and read back."""
    trees = as_replies(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    read = read_back(formatted(trees, keep=2), "leaf")
    turns = F.transform("said", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.split("leaf", "/")[1].cast("bigint").alias("leaf"),
        F.size("said").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
    )


def op8_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and number -7 whose texts are full of control strings."""
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("bigint"),
        "id",
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")),
        F.lit(r"\### Assistant: </turn> ok"),
    )
    rows = given.union(more)
    return digests(formatted(as_chains(rows)))


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length('### ' || replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '),
      ':' || chr(10), ':\' || chr(10)) || ':' || chr(10)
    || replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') || '</turn>' || chr(10)) AS size
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

BRANCHES_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, text NULLS FIRST) AS place
        FROM conversations WHERE turn >= 0) WHERE place = 1
), links AS (
  SELECT c.conv_id, c.turn, p.turn AS above FROM rows c LEFT JOIN rows p
  ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND c.turn > 0 AND p.turn = (c.turn - 1) // 2
), path AS (
  SELECT conv_id, turn AS leaf, turn, 0 AS up FROM rows
  WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.conv_id IS NOT DISTINCT FROM rows.conv_id AND l.above = rows.turn)
  UNION ALL
  SELECT path.conv_id, leaf, l.above, up + 1 FROM path JOIN links l
  ON l.conv_id IS NOT DISTINCT FROM path.conv_id AND l.turn = path.turn WHERE l.above IS NOT NULL
), branch AS (
  SELECT p.conv_id, leaf, sum(length(text) % 97) AS score, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY up DESC)) AS turns_sha256
  FROM path p JOIN rows r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.turn = p.turn GROUP BY p.conv_id, leaf
)
SELECT conv_id, leaf, n_turns, turns_sha256 FROM branch
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, leaf) <= 2
"""
