"""The trie of conversation prefixes, by preorder intervals.

A node is a distinct sequence of first turns.  It is named by a hash of the sequence; the
path to it is spelt by the names of those nodes on it that have siblings (a stretch without
forks needs no spelling), and distinct nodes are ranked by that path, then depth: parents
come before children, and a subtree is an interval.  The end of a node's interval is the
largest rank at which one of its conversations ends.  Leaves and savings of a subtree are
differences of prefix sums over the ranks at both ends.

Texts are hashed and counted where they are read; only narrow rows are shuffled.  Names of
nodes and look-ups of them may be hot (one first turn, one conversation copied): counts and
minima combine before they shuffle, hot look-ups meet a broadcast (``common.looked_up``).
The rows of one conversation are sorted by one task, which spills.

Defined results: a null role or text is empty; turns of one conversation with equal
numbers follow in the order of a hash of role and text, repeated rows are turns each; rows
without a conv_id are of no conversation; a conversation without turns is a member of the
root only; texts of any length are hashed whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import in_order, looked_up, materialise, table

WORD = r"[^\x20\x09-\x0D]+"
ROOT = "root"
#: Members are listed by ranges of so many ids, which a digest then reads one after the other.
IDS_AT_ONCE = 4096
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (from 1), code (of role and text), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    signs = F.rtrim(F.regexp_replace(text, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "\u0001"), F.lit(" \t\n\u000b\u000c\r"))
    code = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    coded = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", code.alias("code"), F.length(signs).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "code")
    return coded.withColumn("n", F.row_number().over(order).cast("long")).select("conv_id", "n", "code", "words")


def joined_openings(rows: DataFrame, group: int = 20, openings: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, n, code, words) and conv_ids after the opening of each conversation gave way to that of its group.

    The first h turns of conversation c - c % ``group`` stand in for the first h of c, where h is crc32(c) % ``openings``.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % openings
    ids = rows.select("conv_id").distinct().withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    base = rows.where((F.col("n") < openings) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    first = ids.join(base, "base").where("n <= h").select("conv_id", F.lit(0).alias("own"), "n", "code", "words")
    rest = rows.where(F.col("n") > h).select("conv_id", F.lit(1).alias("own"), "n", "code", "words")
    order = Window.partitionBy("conv_id").orderBy("own", "n")
    joined = first.unionByName(rest).withColumn("n", F.row_number().over(order).cast("long"))
    return joined.select("conv_id", "n", "code", "words"), ids.select("conv_id")


def paths(rows: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, words, last: a row for each node on each conversation's path, the root left out.

    A sequence's name comes of two sums of 64-bit hashes of (place, turn).
    """
    order = Window.partitionBy("conv_id").orderBy("n")
    parts = [F.xxhash64(F.lit(k), "n", "code").cast("decimal(38,0)") for k in (1, 2)]
    summed = rows.withColumns({f"__p{k}": part for k, part in enumerate(parts)}).withColumns(
        {f"__s{k}": F.sum(f"__p{k}").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("decimal(38,0)") for k in range(2)}
    ).withColumn("last", F.lead("n").over(order).isNull())

    def name(depth: Column, sums: list[Column]) -> Column:
        return F.md5(F.concat_ws(":", depth.cast("string"), *(s.cast("string") for s in sums)))

    n = F.col("n")
    above = name(n - 1, [F.col(f"__s{k}") - F.col(f"__p{k}") for k in range(2)])
    node = name(n, [F.col(f"__s{k}") for k in range(2)])
    return summed.select("conv_id", n.alias("depth"), node.alias("node"), F.when(n == 1, ROOT).otherwise(above).alias("parent"), "words", "last")


def member_digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 of (node, conv_id): the ids ascending, comma-joined.

    Ids are joined by ranges first; a node's ranges are then read in order, a batch at a time, into one digest.
    """
    part = F.floor(F.col("conv_id") / IDS_AT_ONCE)
    listed = ends.groupBy("node", part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != node:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = name, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in range(2)], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], ["node", "ends_sha256"])

    return listed.repartition("node").sortWithinPartitions("node", "part").select("node", "ids").mapInArrow(run, "node string, ends_sha256 string")


def trie(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """A row a node of the turns ``rows`` (conv_id, n, code, words) of the conversations ``ids``: node, parent, conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, rank and stop (its interval), n_leaves, saved_tokens, ends_sha256."""
    ids = materialise(ids, "ids")
    path = materialise(paths(rows), "paths")
    inner = path.groupBy("node", "depth", "parent").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"))
    top = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words")
    )
    counted = materialise(inner.unionByName(top), "counted")
    kids = counted.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = materialise(counted.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "nodes")
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("n_children") > 1).alias("forked"))
    below = looked_up(nodes.where("parent is not null"), parents, "parent")
    top = nodes.where("parent is null").withColumns({"parent_conv_id": F.lit(None).cast("long"), "forked": F.lit(False)})
    nodes = materialise(below.unionByName(top), "nodes")

    # one conversation stands for all its copies: that which is the smallest member of the node where it ends
    ends = path.where("last").select("node", "conv_id")
    leaders = ends.join(nodes.select("node", "conv_id"), ["node", "conv_id"]).select("conv_id", F.col("node").alias("end"))
    led = materialise(path.join(leaders, "conv_id").select("conv_id", "depth", "node", "end"), "led")
    spelt = looked_up(led, nodes.select("node", "forked", F.col("conv_id").alias("__least")), "node")
    order = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spelt = spelt.withColumn("__path", F.collect_list(F.when(F.col("forked"), F.col("node"))).over(order)).where(F.col("conv_id") == F.col("__least"))
    keyed = nodes.join(spelt.select("node", F.array_join("__path", "").alias("__path")), "node", "left").withColumn("__path", F.coalesce("__path", F.lit("")))
    leaf = (F.col("n_children") == 0).cast("long")
    saved = (F.col("n_convs") - 1) * F.col("words")
    keyed = keyed.withColumns({"leaf": leaf, "saved": saved})
    ranked = in_order(materialise(keyed, "keyed"), ["__path", "depth"], ["leaf", "saved"], "ranked")
    ranked = materialise(ranked.drop("__path", "words").withColumnRenamed("place", "rank"), "ranks")

    # what stands before the end of an interval, its last node included
    upto = F.struct(F.col("rank"), (F.col("leaf_before") + F.col("leaf")).alias("leaves"), (F.col("saved_before") + F.col("saved")).alias("saved"))
    ending = ranked.join(leaders.withColumnRenamed("end", "node").select("node"), "node").select(F.col("node").alias("end"), upto.alias("__upto"))
    inside = led.join(ending, "end").select("node", "__upto").unionByName(ending.select(F.lit(ROOT).alias("node"), "__upto"))
    stops = inside.unionByName(ranked.where("parent is null").select("node", upto.alias("__upto"))).groupBy("node").agg(F.max("__upto").alias("__upto"))
    turnless = ids.join(path.select("conv_id").distinct(), "conv_id", "anti").select(F.lit(ROOT).alias("node"), "conv_id")
    out = ranked.join(stops, "node").join(member_digests(ends.unionByName(turnless)), "node", "left")
    last = F.col("__upto")
    return out.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "rank", (last["rank"] + 1).alias("stop"),
        (last["leaves"] - F.col("leaf_before")).alias("n_leaves"), (last["saved"] - F.col("saved_before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )


#: The same in DuckDB: prefixes are lists of turns, and crc32 is reckoned bit by bit.
PREFIX_TRIE_SQL = r"""WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY n) AS turns FROM t GROUP BY 1),
h AS (SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 4 AS h FROM o),
r AS (SELECT a.conv_id, list_concat(coalesce(b.turns[1 : a.h], []), a.turns[a.h + 1 :]) AS turns FROM h a LEFT JOIN o b ON b.conv_id = a.conv_id - a.conv_id % 20),
p AS (SELECT conv_id, len(turns) AS size, d, turns[1 : d] AS path FROM r, unnest(range(len(turns) + 1)) u(d)),
nodes AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
kids AS (SELECT path[1 : d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * len(regexp_extract_all(nodes.path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM nodes LEFT JOIN kids ON nodes.path = kids.path),
sub AS (SELECT w.path[1 : a] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens FROM whole w, unnest(range(d + 1)) u(a) GROUP BY 1)
SELECT w.conv_id, w.d AS depth, up.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM whole w JOIN sub ON sub.path = w.path LEFT JOIN whole up ON w.d > 0 AND up.path = w.path[1 : w.d - 1]"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all conversations, openings joined."""
    rows, ids = joined_openings(materialise(turns(table(spark, sf_dir, "conversations")), "turns"))
    nodes = trie(rows, ids)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
