"""Chat formatting of reply trees.

Root-to-leaf paths come from iterative self-joins with doubling steps: round ``k`` knows the
ancestor ``2**k`` levels up and the sum of scores on the way, so a path of any depth takes as many
rounds as its depth has bits.  Leaves are ranked by these sums; only the chosen ones' paths are
written out, and no row ever holds a whole path before the conversation is written.

The template writes a message as ``<turn:ROLE>TEXT</turn>`` and a line feed.  Inside roles and texts
the backslash and both angle brackets are written as backslash and a letter, so that no text can
look like a mark, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inboxlens.llm.common import settle

OPEN, CLOSE = "<turn:", "</turn>\n"
ASSISTANT = "assistant"
#: Control characters and how they are written, in the order of escaping.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _climbs(known: DataFrame) -> list[DataFrame]:
    """Steps ``(tree, node, above, total)`` to the ancestor ``2**k`` levels up, ``k`` from 0.

    ``total`` sums the scores from the node up to just below that ancestor.
    """
    size = known.count()
    parents = known.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    step = settle(
        known.filter("parent <> node")
        .join(parents, _same(F.col("tree"), F.col("t")) & (F.col("parent") == F.col("n")))
        .select("tree", "node", F.col("parent").alias("above"), F.col("score").alias("total"))
    )
    steps = []
    while not step.isEmpty():
        if len(steps) > size.bit_length():
            raise ValueError("messages reply to each other in a circle")
        steps.append(step)
        on = _step(step)
        step = settle(
            step.join(on, _same(F.col("tree"), F.col("t")) & (F.col("above") == F.col("n"))).select(
                "tree", "node", F.col("further").alias("above"),
                (F.col("total") + F.col("more")).alias("total"),
            )
        )
    return steps


def _step(step: DataFrame) -> DataFrame:
    """A step under names of its own, to be joined."""
    return step.select(
        F.col("tree").alias("t"), F.col("node").alias("n"),
        F.col("above").alias("further"), F.col("total").alias("more"),
    )


def _leaves(known: DataFrame, steps: list[DataFrame]) -> DataFrame:
    every = known.select("tree", F.col("node").alias("leaf"))
    if not steps:
        return every
    inner = steps[0].select(F.col("tree").alias("t"), F.col("above").alias("n"))
    return every.join(
        inner, _same(F.col("tree"), F.col("t")) & (F.col("leaf") == F.col("n")), "left_anti"
    )


def _walk(leaves: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """The given leaves' rows, one for each message on the way to the root: ``node`` and ``up``."""
    names = leaves.columns
    found = leaves.withColumns({"node": F.col("leaf"), "up": F.lit(0)})
    for k, step in enumerate(steps):
        higher = found.join(
            _step(step), _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n"))
        )
        found = settle(
            found.unionByName(
                higher.select(
                    *names, F.col("further").alias("node"), (F.col("up") + 2**k).alias("up")
                )
            )
        )
    return found


def paths(nodes: DataFrame) -> DataFrame:
    """Every root-to-leaf path of ``nodes(tree, node, parent)``, a row a message on it.

    Returns ``(tree, leaf, node, up)``, ``up`` counting levels above the leaf.  A parent that does not
    exist makes its child a root.  Parents in a circle raise ValueError.
    """
    known = settle(
        nodes.select("tree", "node", "parent", F.lit(0.0).alias("score"))
        .filter("node IS NOT NULL")
        .distinct()
    )
    steps = _climbs(known)
    return _walk(_leaves(known, steps), steps)


def best(known: DataFrame, steps: list[DataFrame], branches: int) -> DataFrame:
    """The ``branches`` best leaves of each tree: ``(tree, leaf, branch)``, ``branch`` from 1.

    A leaf's score is the mean score of the messages on its path, ties go to the smaller leaf.  A
    leaf climbs by its depth's powers of two, the largest first, one row all the way: no path is
    written before the leaves are ranked.
    """
    at = _leaves(known, steps).select(
        "tree", "leaf", F.col("leaf").alias("node"), F.lit(0.0).alias("sum"), F.lit(1).alias("length")
    )
    for k in reversed(range(len(steps))):
        up = _step(steps[k])
        at = at.join(
            up, _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n")), "left"
        ).select(
            "tree", "leaf",
            F.coalesce("further", "node").alias("node"),
            (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum"),
            (F.col("length") + F.when(F.col("n").isNull(), 0).otherwise(2**k)).alias("length"),
        )
    roots = known.select(F.col("tree").alias("t"), F.col("node").alias("n"), "score")
    order = Window.partitionBy("tree").orderBy(F.desc("value"), "leaf")
    return (
        at.join(roots, _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n")))
        .select("tree", "leaf", ((F.col("sum") + F.col("score")) / F.col("length")).alias("value"))
        .withColumn("branch", F.row_number().over(order))
        .filter(F.col("branch") <= branches)
        .select("tree", "leaf", "branch")
    )


def conversations(messages: DataFrame, *, branches: int = 1) -> DataFrame:
    """One formatted conversation for each of the best branches of every tree.

    ``messages(tree, node, parent, role, text, score)``; other columns are not read.  Null roles and
    texts are empty, null scores 0.  Rows that repeat a node of a tree are one message, the smallest by parent,
    role and text; rows without a node are left out; a null tree is a tree of its own.  An empty
    table gives no conversation.

    Returns ``(tree, leaf, branch, formatted, loss)``; ``loss`` lists start and length, in code
    points of ``formatted``, of every assistant text.
    """
    one = settle(
        messages.filter("node IS NOT NULL")
        .select(
            "tree", "node",
            F.struct(
                F.col("parent").alias("parent"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
                F.col("score").alias("score"),
            ).alias("message"),
        )
        .groupBy("tree", "node")
        .agg(F.min("message").alias("message"))
        .select("tree", "node", "message.*")
        .withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    )
    steps = _climbs(one)
    chosen = _walk(settle(best(one, steps, branches)), steps)
    said = one.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), "role",
        F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">")).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    rows = chosen.join(said, _same(F.col("tree"), F.col("t")) & (F.col("node") == F.col("n")))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))
    length = F.length("head") + F.length("body") + len(CLOSE)
    turns = rows.select(
        "tree", "leaf", "branch",
        F.struct(
            (-F.col("up")).alias("at"),
            F.concat("head", "body", F.lit(CLOSE)).alias("turn"),
            (F.col("role") == ASSISTANT).alias("learn"),
            (F.sum(length).over(before) - length + F.length("head")).alias("start"),
            F.length("body").cast("bigint").alias("length"),
        ).alias("turn"),
    )
    return (
        turns.groupBy("tree", "leaf", "branch")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select(
            "tree", "leaf", "branch",
            F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
            F.transform(
                F.filter("turns", lambda t: t["learn"]),
                lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
            ).alias("loss"),
        )
    )


def read_back(formatted: Column) -> Column:
    """The ``(role, text)`` turns that a formatted conversation holds."""
    marked = F.filter(F.split(formatted, CLOSE), lambda t: t != "")

    def turn(t: Column) -> Column:
        inner = F.substring(t, len(OPEN) + 1, F.length(t))
        end = F.locate(">", inner)
        return F.struct(
            unescape(F.substring(inner, F.lit(1), end - 1)).alias("role"),
            unescape(F.substring(inner, end + 1, F.length(inner))).alias("text"),
        )

    return F.transform(marked, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            loss,
            lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )


def from_turns(rows: DataFrame) -> DataFrame:
    """``conversations(conv_id, turn, role, text)`` as trees without branches.

    Rows follow each other by turn, then role and text; every row replies to the one before.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order)).select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


QUERY = "op4_chat_formatting"
PROBE = "\\### Assistant: </turn> ok"

_ESCAPED = "replace(replace(replace({}, '\\', '\\b'), '<', '\\l'), '>', '\\g')"
SQL = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})
             + {len(OPEN) + 1 + len(CLOSE)})::BIGINT AS formatted_chars
  FROM every GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM whole
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: all ``conversations`` and the probe, read back from their formatted form."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    written = settle(conversations(from_turns(rows.unionByName(probe))))
    turns = read_back(F.col("formatted"))
    said = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = loss_text(F.col("formatted"), F.col("loss"))
    return written.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(under).cast("bigint").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
