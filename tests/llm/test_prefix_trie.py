import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from holdfast.llm import prefix_trie as P

from .conftest import WORD

SCHEMA = "conv_id long, turn long, role string, text string, head long, depth long, pos long, a long"


def positions(rows):
    """Turns of each conversation in order."""
    key = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            out.setdefault(conv, []).append((turn is not None, turn or 0, key(role, text), role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in out.items()}


def rebuilt(convs):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
    return {c: convs.get(c - c % 20, [])[: h[c]] + v[h[c] :] for c, v in convs.items()}


def nodes(convs):
    """Every distinct start of the conversations, with all its members compared."""
    starts = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            starts.setdefault(tuple(turns[:d]), []).append(c)
    children, out = {}, {}
    for s in starts:
        if s:
            children.setdefault(s[:-1], []).append(s)
    leaves, saved = {}, {}
    for s in sorted(starts, key=len, reverse=True):
        below = children.get(s, [])
        leaves[s] = sum(leaves[b] for b in below) or 1
        words = len(WORD.findall(s[-1][1])) if s else 0
        saved[s] = sum(saved[b] for b in below) + (len(starts[s]) - 1) * words
        ends = ",".join(map(str, sorted(c for c in starts[s] if len(convs[c]) == len(s))))
        parent = min(starts[s[:-1]]) if s else None
        out[min(starts[s]), len(s)] = (parent, len(starts[s]), len(below), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def found(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = df.collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def random_rows(seed, convs=60):
    """Few different turns, so that starts are shared at all depths; equal conversations; one that all others begin with."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        length = rng.choice([1, 1, 2, 3, 5, 8])
        rows += [(c, t, rng.choice(["user", "user", "bot"]), rng.choice(["a", "b c", "", None])) for t in range(length)]
    for c in range(200, 230):  # copies
        rows += [(c, t, "user", f"same {t}") for t in range(9)]
    for c in range(300, 312):  # each goes on one turn longer
        rows += [(c, t, "bot", f"grows {t}") for t in range(c - 299)]
    rows += [(400, t, "user", f"long {t}") for t in range(150)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("capacity", [1, 12, 100, 10**6])
def test_equals_brute_force(spark, monkeypatch, capacity):
    monkeypatch.setattr(P, "CHUNK", 5)
    rows = random_rows(capacity)
    turns, lengths = P.turns_of(table(spark, rows).repartition(5))
    convs = positions(rows)
    assert {r.conv_id: r.turns for r in lengths.collect()} == {c: len(v) for c, v in convs.items()}
    assert found(P.trie(turns, lengths, capacity)) == nodes(convs)


@pytest.mark.parametrize("capacity", [12, 10**6])
def test_rebuilt_conversations(spark, capacity):
    rows = random_rows(3)
    rows += [(519, 0, "user", "no base"), (10**18 + 40, 5, "user", "x"), (10**18 + 47, None, "bot", "y"), (-7, 1, "user", "z")]
    rows += [(c, 0, "user", "alone") for c in range(601, 640)]
    got = found(P.trie(*P.with_shared_starts(*P.turns_of(table(spark, rows))), capacity))
    convs = {c: v for c, v in positions(rows).items() if c >= 0}
    h, base = zlib.crc32(b"-7") % 4, []  # SQL's remainder: the base of -7 is 0
    base = positions(rows)[0][:h]
    want = rebuilt(convs) | {-7: base + positions(rows)[-7][h:]}
    assert got == nodes(want) and any(not v for v in want.values())


@pytest.mark.parametrize("capacity", [1, 10**6])
def test_edges(spark, capacity):
    long = " ".join(f"w{k}" for k in range(50_000))
    rows = [(1, None, "user", None), (1, 0, None, ""), (1, 0, None, ""), (1, 0, "bot", "b"), (1, 0, "bot", "a"), (None, 1, "user", "lost")]
    rows += [(2, None, "user", ""), (2, None, "user", "中 é"), (3, 7, "user", long), (4, 9, "user", long), (5, 1, "", "user")]
    got = found(P.trie(*P.turns_of(table(spark, rows)), capacity))
    assert got == nodes(positions(rows))
    assert any(v[4] >= 50_000 for v in got.values())
    nothing = P.trie(*P.with_shared_starts(*P.turns_of(table(spark, []))), capacity)
    assert found(nothing) == {} and found(P.trie(*P.turns_of(table(spark, rows[5:6])), capacity)) == {}
    one = [(8, t, "user", "t") for t in range(30)]
    assert found(P.trie(*P.turns_of(table(spark, one)), capacity)) == nodes(positions(one))


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "1:a", "bc")]
    assert len(found(P.trie(*P.turns_of(table(spark, rows))))) == 5


def test_hot_groups(spark):
    """A third of the turns in one conversation, a third in copies, and one first turn for the rest: few levels, all rows."""
    n = 30_000
    one = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    copies = spark.range(n).select((100 + F.floor(F.col("id") / 3)).alias("conv_id"), (F.col("id") % 3).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("copy "), F.col("id") % 3).alias("text"))
    first = spark.range(n).select((50_000 + F.floor(F.col("id") / 2)).alias("conv_id"), (F.col("id") % 2).alias("turn"), F.lit("user").alias("role"),
                                  F.when(F.col("id") % 2 == 0, "hello you").otherwise(F.concat(F.lit("x"), "id")).alias("text"))
    turns, lengths = P.turns_of(one.unionByName(copies).unionByName(first))
    got = {(r.conv_id, r.depth): r for r in P.trie(turns, lengths, 1000).collect()}
    assert len(got) == 1 + n + 3 + 1 + n // 2
    root, hello, end = got[1, 0], got[50_000, 1], got[100, 3]
    assert (root.n_convs, root.n_children, root.n_leaves) == (1 + n // 3 + n // 2, 3, 2 + n // 2)
    assert (hello.n_convs, hello.n_children, hello.saved_tokens) == (n // 2, n // 2, 2 * (n // 2 - 1))
    assert end.ends_sha256 == hashlib.sha256(",".join(str(100 + k) for k in range(n // 3)).encode()).hexdigest()
