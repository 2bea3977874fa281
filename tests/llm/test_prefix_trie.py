"""Prefix trie against SQL, against all prefixes of every conversation, and on odd rows."""

import hashlib
import random
import re
import zlib

from ledgerlake.llm import prefix_trie as T
from ledgerlake.llm.queries import ORACLE, QUERIES
from llm_data import SF_SMALL, duck  # noqa: F401
from tools.check_oracle import digest

DDL = "conv_id long, turn long, role string, text string, node string, depth int, ended string"


def ordered(rows):
    """conv_id -> its (role, text) in order."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role, key, text))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members, ends = {}, {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
        ends.setdefault(tuple(ts), []).append(c)
    nodes = sorted(members, key=len, reverse=True)
    kids, leaves, saved = {}, {}, {}
    for n in nodes:
        leaves[n] = leaves.get(n, 0) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        saved[n] = saved.get(n, 0) + (len(members[n]) - 1) * words
        if n:
            up = n[:-1]
            kids[up] = kids.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[n]
            saved[up] = saved.get(up, 0) + saved[n]
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else -1, len(members[n]), kids.get(n, 0), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n in nodes
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def collected(nodes):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in nodes.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL)


def test_query_matches_sql(spark, duck):
    df = QUERIES["op12_prefix_trie"](spark, SF_SMALL)
    res = duck.execute(ORACLE["op12_prefix_trie"])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns) == sorted(COLUMNS)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def odd_rows():
    rng = random.Random(1)
    rows = [(c, t, rng.choice("ua"), rng.choice(["a b", "c", "", None])) for c in range(-25, 60, 2) for t in range(rng.randrange(1, 7))]
    rows += [(5, None, None, "first"), (5, None, None, "first"), (7, 3, "u", None), (None, 1, "u", "lost"), (400, 0, "u", "one")]
    deep = [("u", f"turn {k}") for k in range(150)]
    for c in (1000, 1020, 1040, 1060, 1080):  # long copies, and branches of them
        own = deep[:150] if c < 1040 else deep[: rng.randrange(100, 140)] + [("a", f"end {c}")]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(own)]
    return rows + [r for r in rows[:10]]


def test_trie_of_odd_rows_equals_all_prefixes(spark):
    rows = odd_rows()
    assert collected(T.conversation_trie(frame(spark, rows))) == brute(ordered(rows))
    assert collected(T.trie(T.branched(frame(spark, rows)))) == brute(rebuilt(ordered(rows)))


def test_a_conversation_of_many_turns_and_one_of_many_copies(spark):
    rows = [(1, k, "u", f"w{k}") for k in range(3000)]
    rows += [(c, k, "u", f"hot {k}") for c in range(2, 3000) for k in range(2)]
    assert collected(T.conversation_trie(frame(spark, rows))) == brute(ordered(rows))


def test_ids_of_a_node_are_hashed_piece_by_piece(spark):
    ids = list(range(5000))
    ended = spark.createDataFrame([(bytearray(b"n" * 16), c) for c in ids] + [(bytearray(b"m" * 16), 7)], "node binary, conv_id long")
    got = {bytes(r["node"]): r["ends_sha256"] for r in T.ends_digests(ended, piece=100).collect()}
    assert got == {
        b"n" * 16: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        b"m" * 16: hashlib.sha256(b"7").hexdigest(),
    }


def test_turnless_conversations_and_empty_tables(spark):
    rows = [(23, 0, "u", "only")]  # takes more turns from 20 than there are, and none of its own are left if h > 0
    assert collected(T.trie(T.branched(frame(spark, rows)))) == brute(rebuilt(ordered(rows)))
    empty = frame(spark, rows).limit(0)
    assert T.trie(T.branched(empty)).count() == 0 and T.conversation_trie(empty).count() == 0
    assert T.conversation_trie(frame(spark, [(None, 1, "u", "lost")])).count() == 0
