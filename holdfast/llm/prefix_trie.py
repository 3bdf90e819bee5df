"""Prefix trie of conversations, built as a burst trie.

A node is a distinct sequence of first turns. It is named by its depth and its
smallest member, as a conversation passes one node at each depth. A container holds
the rest of every conversation below a head, which is a node. A container of more
turns and members than ``capacity`` bursts: the turns that all its members share
become nodes under its head, and the next turn id deals the rest to containers of
their own, one level down. This goes on until all containers fit. Those are dealt to
shards by a hash of their head, and a task reads one container at a time, sorts its
suffixes and sweeps them into nodes with one stack. Containers of one member are a
chain without branches and need no task to hold them, however long they are.

What a subtree sums (leaves, saved tokens) comes up level by level: a burst head adds
the totals of the containers below it. A group of equal conversations, or of
conversations with one first turn, may hold most rows: it bursts until its members
part or end. Levels are at most the branchings above a container that fits.

Positions come from one range sort of all turns, so a conversation with a third of
the rows lies in many range partitions. Turns are told apart by 128 bits of MD5 over
role and text. Ids that end at a burst head are range-sorted and joined to texts of
a megabyte at most before they reach the one task that a node's digest needs.

Cases: null role and text count as empty; a null turn comes first; rows of one turn
number are ordered by the MD5 of role and text, repeated rows are turns of their own;
rows without a conversation id belong to none and are left out; texts of any length
are read whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.ordering import range_segments
from holdfast.llm.store import registry, text_of, written
from holdfast.llm.text import WORD

CAPACITY = 1 << 14  # turns and members of a container that one task sorts
CHUNK = 1 << 20  # characters of joined ids
_CONTAINER = ["head", "depth"]

QUERIES, ORACLE, query = registry()


def turns_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``conv_id, pos, a, b, words`` with positions from 1, ``conv_id, turns``), both written tables."""
    role, text = text_of(conversations, "role"), text_of(conversations, "text")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = range_segments(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key")])
    # of each conversation and range partition: where it begins, and how many rows lie in earlier partitions
    earlier = W.partitionBy("conv_id").orderBy("_segment").rowsBetween(W.unboundedPreceding, -1)
    runs = placed.groupBy("conv_id", "_segment").agg(F.min("_place").alias("first"), F.count("*").alias("n"))
    runs = written(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "runs")
    half = lambda at: F.conv(F.substring("key", at, 16), 16, -10).cast("long")
    turns = placed.join(runs, ["conv_id", "_segment"]).select(
        "conv_id", (F.col("_place") - F.col("first") + F.col("before") + 1).alias("pos"), half(1).alias("a"), half(17).alias("b"), "words"
    )
    return written(turns, "turns"), written(runs.groupBy("conv_id").agg(F.sum("n").alias("turns")), "lengths")


def with_shared_starts(turns: DataFrame, lengths: DataFrame, every: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c begins with the first h turns of c - c % ``every``; its own follow after their first h.

    h = crc32(decimal c) % ``longest``. A start has ``longest`` - 1 turns at most and goes to ``every`` conversations.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    base = lengths.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns"))
    convs = lengths.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % every).join(base, "base", "left")
    convs = convs.withColumn("start", F.least("h", F.coalesce("base_turns", F.lit(0))))
    convs = written(convs, "starts")
    starts = turns.where(F.col("pos") < longest).withColumnRenamed("conv_id", "base")
    starts = starts.join(convs.select("base", "conv_id", "start"), "base").where("pos <= start")
    own = turns.where(F.col("pos") > h).join(convs.select("conv_id", (F.col("start") - F.col("h")).alias("by")), "conv_id")
    own = own.withColumn("pos", F.col("pos") + F.col("by"))
    rebuilt = starts.select(turns.columns).unionByName(own.select(turns.columns))
    total = F.col("start") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    return written(rebuilt, "rebuilt"), convs.select("conv_id", total.alias("turns"))


def _fits(capacity: int) -> Column:
    """Whether a container stays as it is; a chain below the root always does."""
    return (F.col("n_convs") + F.col("rest") <= capacity) | ((F.col("n_convs") == 1) & (F.col("depth") > 0))


def _swept(rows: list[tuple[int, list[int]]], words: list[int], depth: int, head_words: int) -> list[list]:
    """Nodes of a container's suffixes (conversation, turn numbers), the head first.

    A node: depth, parent's place, smallest member, members, children, leaves, saved tokens, ends, own words.
    """
    nodes = [[depth, -1, None, 0, 0, 0, 0, [], head_words]]
    path, before = [nodes[0]], []
    places = [0]
    for suffix, conv in sorted((suffix, conv) for conv, suffix in rows):
        common = 0
        for x, y in zip(suffix, before):
            if x != y:
                break
            common += 1
        del path[common + 1 :], places[common + 1 :]
        for turn in suffix[common:]:
            node = [depth + len(path), places[-1], None, 0, 0, 0, 0, [], words[turn]]
            path[-1][4] += 1
            places.append(len(nodes))
            nodes.append(node)
            path.append(node)
        for node in path:
            node[3] += 1
            if node[2] is None or conv < node[2]:
                node[2] = conv
        path[-1][7].append(conv)
        before = suffix
    for node in reversed(nodes):  # children come after their parent
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * node[8]
        if node[1] >= 0:
            nodes[node[1]][5] += node[5]
            nodes[node[1]][6] += node[6]
    return nodes


def _ids_digest(convs: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(convs))).encode()).hexdigest()


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SWEPT = _NODE + ", top boolean, up_depth long"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers that come one after the other, members and turns in order."""
    held: list[pa.RecordBatch] = []

    def finish() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        one = lambda c: table.column(c)[0].as_py()
        numbers: dict[tuple[int, int], int] = {}
        words: list[int] = []
        rows: list[tuple[int, list[int]]] = []
        for conv, pos, a, b, w in zip(*(table.column(c).to_pylist() for c in ("conv_id", "pos", "a", "b", "words"))):
            if not rows or rows[-1][0] != conv:
                rows.append((conv, []))
            if pos is not None:
                turn = numbers.setdefault((a, b), len(words))
                if turn == len(words):
                    words.append(w)
                rows[-1][1].append(turn)
        nodes = _swept(rows, words, one("depth"), one("head_words"))
        parents = [nodes[n[1]][2] if n[1] >= 0 else one("up_head") for n in nodes]
        columns = [[n[2] for n in nodes], [n[0] for n in nodes], parents, *[[n[k] for n in nodes] for k in (3, 4, 5, 6)]]
        arrays = [pa.array(c, pa.int64()) for c in columns]
        arrays.append(pa.array([_ids_digest(n[7]) for n in nodes]))
        arrays.append(pa.array([n[1] < 0 for n in nodes]))
        arrays.append(pa.array([one("up_depth")] * len(nodes), pa.int64()))
        names = [c.split()[0] for c in _SWEPT.split(", ")]
        yield pa.RecordBatch.from_arrays(arrays, names=names)
        held.clear()

    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(c)) for c in _CONTAINER]
        cuts = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = (keys[0][lo], keys[1][lo])
            if held and key != now:
                yield from finish()
            now = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield from finish()


def _ends(ended: DataFrame) -> DataFrame:
    """``head, depth, ends_sha256`` of rows of ``head, depth, conv_id``."""
    order = [*_CONTAINER, "conv_id"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, parts, size = None, None, [], 0
        packed = lambda: pa.record_batch([[now[0]], [now[1]], [first], [",".join(parts)]], names=[*order, "ids"])
        for batch in batches:
            for head, depth, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if (head, depth) != now or size > CHUNK:
                    if parts:
                        yield packed()
                    now, first, parts, size = (head, depth), conv, [], 0
                parts.append(str(conv))
                size += len(parts[-1]) + 1
        if parts:
            yield packed()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        done = lambda: pa.record_batch([[now[0]], [now[1]], [state.hexdigest()]], names=[*_CONTAINER, "ends_sha256"])
        for batch in batches:
            for head, depth, ids in zip(*(batch.column(c).to_pylist() for c in (*_CONTAINER, "ids"))):
                if (head, depth) == now:
                    state.update(b",")
                else:
                    if now is not None:
                        yield done()
                    now, state = (head, depth), hashlib.sha256()
                state.update(ids.encode())
        if now is not None:
            yield done()

    joined = ended.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = joined.mapInArrow(join, "head long, depth long, conv_id long, ids string")
    return joined.repartition(*_CONTAINER).sortWithinPartitions(*order).mapInArrow(digest, "head long, depth long, ends_sha256 string")


def _burst(turns: DataFrame, big: DataFrame, members: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Of containers that do not fit: their heads, chain nodes, ended members, and the containers and members one level down."""
    active = members.where("NOT fits").select("conv_id", "turns", *_CONTAINER, "n_convs")
    ahead = turns.join(active, "conv_id").where("pos > depth")
    of_turn = lambda f, name: [f(c).alias(f"{name}_{c}") for c in ("a", "b")]
    at = ahead.groupBy(*_CONTAINER, "n_convs", "pos").agg(
        *of_turn(F.min, "least"), *of_turn(F.max, "most"), F.count("*").alias("n"), F.max("words").alias("words")
    )
    parts = (F.col("n") < F.col("n_convs")) | (F.col("least_a") != F.col("most_a")) | (F.col("least_b") != F.col("most_b"))
    at = written(at.select(*_CONTAINER, "pos", "words", parts.alias("parts")), "positions")
    # the first position where not all members go on with one turn
    split = at.groupBy(*_CONTAINER).agg(F.coalesce(F.min(F.when(F.col("parts"), F.col("pos"))), F.max("pos") + 1).alias("split"))
    heads = big.select(*_CONTAINER, "n_convs", "head_words", "up_head", "up_depth").join(split, _CONTAINER, "left")
    heads = written(heads.withColumn("split", F.coalesce("split", F.col("depth") + 1)), "heads")
    shared = at.join(heads, _CONTAINER).where("pos < split")
    chain = heads.select(*heads.columns, F.col("depth").alias("pos"), F.col("head_words").alias("words"))
    chain = chain.unionByName(shared.select(chain.columns))
    marks = heads.select(*_CONTAINER, "split")
    ended = active.join(marks, _CONTAINER).where("turns = split - 1").select(*_CONTAINER, "conv_id")
    onward = ahead.drop("n_convs").join(marks, _CONTAINER).where("pos = split")
    onward = onward.select("conv_id", "turns", F.col("head").alias("up_head"), F.col("depth").alias("up_depth"), "pos", "a", "b", "words")
    by_turn = ["up_head", "up_depth", "a", "b"]
    children = onward.groupBy(*by_turn).agg(
        F.min("conv_id").alias("head"),
        F.max("pos").alias("depth"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("turns") - F.col("pos")).alias("rest"),
        F.max("words").alias("head_words"),
    )
    children = written(children.withColumn("fits", _fits(capacity)), "containers")
    below = onward.select("conv_id", "turns", *by_turn).join(children, by_turn)
    return heads, chain, ended, children, written(below.select(members.columns), "members")


def trie(turns: DataFrame, lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every node of conversations given by ``conv_id, pos, a, b, words`` and ``conv_id, turns`` (which may be 0)."""
    spark = turns.sparkSession
    least, n, total = lengths.agg(F.min("conv_id"), F.count("*"), F.coalesce(F.sum("turns"), F.lit(0))).first()
    names = [c.split()[0] for c in _NODE.split(", ")]
    if not n:
        return spark.createDataFrame([], _NODE)
    over = n + total > capacity
    root = {"head": least, "depth": 0, "n_convs": n, "head_words": 0, "up_head": None, "up_depth": None}
    root = {c: F.lit(v).cast("long") for c, v in root.items()} | {"fits": F.lit(not over)}
    members = lengths.select("conv_id", "turns", *[v.alias(c) for c, v in root.items()])
    big = spark.range(1).select(*[v.alias(c) for c, v in root.items()])
    fitting, levels = [], []
    while True:
        fitting.append(members.where("fits"))
        if not over:
            break
        heads, chain, ended, children, members = _burst(turns, big.where("NOT fits"), members, capacity)
        levels.append((heads, chain, ended))
        big, over = children, bool(children.where("NOT fits").limit(1).count())
    settled = reduce(DataFrame.unionByName, fitting)
    nothing = F.sha2(F.lit(""), 256)

    alone = (F.col("n_convs") == 1) & (F.col("depth") > 0)
    lone = turns.join(settled.where(alone).select("conv_id", "turns", "depth", "up_head", "up_depth"), "conv_id").where("pos >= depth")
    own_end = F.when(F.col("pos") == F.col("turns"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(nothing)
    lone = lone.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.when(F.col("pos") == F.col("depth"), F.col("up_head")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        (F.col("pos") < F.col("turns")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        own_end.alias("ends_sha256"),
        (F.col("pos") == F.col("depth")).alias("top"),
        "up_depth",
    )
    held = settled.where(~alone).select("conv_id", *_CONTAINER, "head_words", "up_head", "up_depth")
    rest = turns.select(F.col("conv_id").alias("_conv"), "pos", "a", "b", "words")
    held = held.join(rest, (F.col("conv_id") == F.col("_conv")) & (F.col("pos") > F.col("depth")), "left").drop("_conv")
    held = held.repartition(*_CONTAINER).sortWithinPartitions(*_CONTAINER, "conv_id", "pos")
    swept = written(lone.unionByName(held.mapInArrow(_sweep, _SWEPT)), "nodes")
    if not levels:
        return swept.select(names)

    def below(tops: DataFrame) -> DataFrame:
        """What the containers under a head add to it."""
        up = [F.col("up_head").alias("head"), F.col("up_depth").alias("depth")]
        return tops.groupBy(*up).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("children")
        )

    tops = ["up_head", "up_depth", "n_leaves", "saved_tokens"]
    at_top = swept.where("top").withColumnRenamed("parent_conv_id", "up_head").select(tops)
    deeper, nodes = None, []
    onward = W.partitionBy(*_CONTAINER).orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, 0)
    for heads, chain, _ in reversed(levels):
        children = below(at_top if deeper is None else at_top.unionByName(deeper)).join(heads.select(*_CONTAINER), _CONTAINER, "left_semi")
        sums = chain.join(children, _CONTAINER, "left")
        last = F.col("pos") == F.col("split") - 1
        saved = F.sum((F.col("n_convs") - 1) * F.col("words")).over(onward) + F.coalesce("saved", F.lit(0))
        found = sums.select(
            F.col("head").alias("conv_id"),
            F.col("pos").alias("depth"),
            F.when(F.col("pos") == F.col("depth"), F.col("up_head")).otherwise(F.col("head")).alias("parent_conv_id"),
            "n_convs",
            F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            saved.alias("saved_tokens"),
            (F.col("pos") == F.col("depth")).alias("top"),
            "up_depth",
            last.alias("last"),
            F.col("depth").alias("from"),
        )
        found = written(found, "burst")
        nodes.append(found)
        deeper = found.where("top").withColumnRenamed("parent_conv_id", "up_head").select(tops)
    ends = _ends(reduce(DataFrame.unionByName, [ended for *_, ended in levels]))
    ends = ends.select(F.col("head").alias("_head"), F.col("depth").alias("_from"), "ends_sha256")
    burst = reduce(DataFrame.unionByName, nodes)
    at_end = F.col("last") & (F.col("conv_id") == F.col("_head")) & (F.col("from") == F.col("_from"))
    burst = burst.join(ends, at_end, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    return swept.select(names).unionByName(burst.select(names))


@query(
    r"""
    WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                          md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
               FROM conversations WHERE conv_id IS NOT NULL),
    i AS (SELECT conv_id, conv_id - conv_id % 20 AS base, CAST(conv_id AS VARCHAR) AS dec FROM c GROUP BY conv_id),
    h AS (SELECT conv_id, base, xor(list_reduce(list_concat([4294967295::BIGINT],
                     list_transform(string_split(dec, ''), lambda x: ascii(x)::BIGINT)),
                     lambda s, x: list_reduce([xor(s, x), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
                                           lambda t, z: xor(t >> 1, 3988292384::BIGINT * (t & 1)))), 4294967295::BIGINT) % 4 AS h FROM i),
    r AS (SELECT h.conv_id, c.pos AS place, role, text FROM h JOIN c ON c.conv_id = h.base AND c.pos <= h.h
          UNION ALL SELECT h.conv_id, 10 + c.pos, role, text FROM h JOIN c ON c.conv_id = h.conv_id AND c.pos > h.h),
    s AS (SELECT conv_id, text, row_number() OVER w AS depth, list([role, text]) OVER w AS path
          FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT conv_id, depth, md5(CAST(path AS VARCHAR)) AS key, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM s
          UNION ALL SELECT conv_id, 0, '', 0 FROM h),
    e AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends,
                 lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p),
    n AS (SELECT key, any_value(up) AS up, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM e GROUP BY key),
    k AS (SELECT up, count(*) AS n_children FROM n GROUP BY up),
    t AS (SELECT e.key, count(DISTINCT d.key) FILTER (WHERE k.up IS NULL) AS n_leaves FROM e JOIN e f ON f.conv_id = e.conv_id AND f.depth >= e.depth
          JOIN n d ON d.key = f.key LEFT JOIN k ON k.up = d.key GROUP BY e.key),
    v AS (SELECT key, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM
            (SELECT DISTINCT e.key, d.key AS below, (d.n_convs - 1) * d.words AS saved
             FROM e JOIN e f ON f.conv_id = e.conv_id AND f.depth >= e.depth JOIN n d ON d.key = f.key) GROUP BY key)
    SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, t.n_leaves,
           v.saved_tokens, n.ends_sha256
    FROM n LEFT JOIN n u ON n.up = u.key LEFT JOIN k ON k.up = n.key JOIN t ON t.key = n.key JOIN v ON v.key = n.key
    """
)
def op11_prefix_trie(spark, sf_dir):
    turns, lengths = turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie(*with_shared_starts(turns, lengths))
