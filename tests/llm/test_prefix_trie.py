import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tripleloom.llm import prefix_trie as trie
from tripleloom.llm.queries import CONVERSATIONS, op11_burst_trie

KIND = "conv_id long, turn long, role string, text string, ids string, n int, head string, depth int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "i", 1, "h", 2) for r in rows], KIND)


def slow(rows):
    """All nodes by lists and dictionaries alone."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: tuple(t for _, t in sorted(v)) for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - (c % 5 if c >= 0 else -(-c % 5)), ())[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += gain
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


COLUMNS = [c.split()[0] for c in trie.NODE.split(", ")]


def found(frame):
    rows = (tuple(r[c] for c in COLUMNS) for r in frame.select(*COLUMNS).collect())
    return sorted(tuple(-1 if x is None else x for x in r) for r in rows)


@pytest.mark.parametrize("limit", [1 << 16, 40, 3, 0])
def test_given_conversations(spark, tiny, limit):
    rows = spark.read.parquet(f"{tiny}/conversations.parquet")
    assert found(trie.prefix_trie(rows, limit)) == slow([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


def chats(seed, n):
    """Conversations that share starts, with copies, long common prefixes and all awkward values."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        start = [("system", "be brief")] * rng.randint(0, 2) + [("user", f"q{k}") for k in range(rng.choice([0, 1, 12, 12]))]
        tail = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ccc", "", None, "é"])) for _ in range(rng.randint(1, 5))]
        turns = start + tail
        number = rng.choice([c, c, c, c * 1000 + 1, -c - 1])
        rows += [(number, t, role, text) for t, (role, text) in enumerate(turns)]
        if rng.random() < 0.2:
            rows += [(number, rng.choice([None, 0, 1]), role, text) for role, text in turns[:2]]
    rows += [(None, 0, "user", "nobody"), (n * 5 + 3, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,limit", [(1, 1 << 16), (2, 30), (3, 5), (4, 1)])
def test_shared_starts_and_awkward_rows(spark, seed, limit):
    rows = chats(seed, 120)
    assert found(trie.prefix_trie(table(spark, rows), limit)) == slow(rows)


def test_one_long_conversation_and_its_prefixes(spark):
    """Every burst takes one sequence off a common stem, the case with the most heads."""
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(c)]
    assert found(trie.prefix_trie(table(spark, rows), 20)) == slow(rows)


def test_many_equal_conversations_are_digested_in_runs(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 40)
    rows = [(c * 7, 0, "user", "hello") for c in range(900)] + [(c * 7, 1, "bot", "hi") for c in range(0, 900, 2)]
    assert found(trie.prefix_trie(table(spark, rows))) == slow(rows)


def test_nothing_and_root_alone(spark):
    assert found(trie.prefix_trie(table(spark, []))) == [] and found(trie.prefix_trie(table(spark, [(None, 1, "a", "b")]))) == []
    # 3's base is absent and 3 keeps nothing of its one turn: a member of the root alone
    assert zlib.crc32(b"3") % 9 > 0
    rows = [(3, 0, "user", "x")]
    assert found(trie.prefix_trie(table(spark, rows))) == slow(rows) == [(3, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]


def test_against_sql(spark, tiny):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tiny}/conversations.parquet'")
    told = con.execute(CONVERSATIONS)
    names = [d[0] for d in told.description]
    rows = sorted(tuple(-1 if x is None else x for x in (dict(zip(names, r))[c] for c in COLUMNS)) for r in told.fetchall())
    assert found(op11_burst_trie(spark, tiny)) == rows
