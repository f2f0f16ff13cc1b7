"""Conversation repair: faults, cheapest edits and ASCII-least audits against plain dynamic programming; segments against whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from indicata.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((0, 1, 2)[1 + (kind == 3)] if kind else 0):
            yield conv, turn, role, text


def cheapest(said):
    """(cost, audit, repaired lines) by trying every edit in every place."""
    seen, faults = set(), []
    for row in said:
        end = re.findall(r"[^\x20\x09-\x0D]", row[1])
        faults.append("blank" if not end else "duplicate" if row in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add(row)

    def after(place, initial):  # places: "", "s", "u", "a"
        if initial == "s" and place == "":
            return "s"
        if initial == "u" and place in ("", "s", "a"):
            return "u"
        return "a" if initial == "a" and place == "u" else None

    @lru_cache(None)
    def best(i, place, inserts=0):
        options = []
        if i == len(said) and place in ("", "a"):
            options.append((0, "", ()))
        if inserts < 3:
            for role in ("user", "assistant"):
                if after(place, role[0]):
                    c, a, lines = best(i, after(place, role[0]), inserts + 1)
                    options.append((c + 3, "I" + a, (role + ":", *lines)))
        if i < len(said):
            (role, text), fault = said[i], faults[i]
            c, a, lines = best(i + 1, place)
            options.append((c + 4, "D" + a, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if after(place, role[:1]):
                    c, a, lines = best(i + 1, after(place, role[:1]))
                    options.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
                for new in ("user", "assistant"):
                    if after(place, new[0]):
                        c, a, lines = best(i + 1, after(place, new[0]))
                        options.append((c + 3 + more, "R" + a, (f"{new}:{text}", *lines)))
        return min(options, default=(10**9, "", ()))

    for i in range(len(said), 0, -1):  # from the end, so that no recursion is deep
        for place in ("", "s", "u", "a"):
            best(i, place)
    cost, audit, lines = best(0, "")
    return faults, cost, audit, lines


def brute(rows):
    conversations = {r[0]: [] for r in rows}
    for r in damage(rows):
        conversations[r[0]].append(r)
    out = []
    for conv, kept in conversations.items():
        kept.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [r[2:] for r in kept]
        turns = {r[1] for r in kept if r[1] is not None}
        faults, cost, audit, lines = cheapest(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"),
    (2, 5, "assistant", "End."), (2, 9, "system", "Be kind!"), (2, 9, "system", "Be kind!"), (2, None, "user", None),
    (3, None, None, None), (None, 3, "user", "no end"), (None, 4, "assistant", "an end!  \n"), (None, None, "tool", "data."),
    (4, 1, "", "no role."), (4, 2, "user", " \t\x0b"), (4, 3, "assistant", "x" * 300_000 + "."),
    (5, -3, "user", "a."), (5, 7, "user", "a."), (5, 7, "assistant", "a."), (5, 8, "understudy", "öä…"), (5, 8, "s", "!"),
]


def many(seed, conversations, most, texts=6):
    r = random.Random(seed)
    return [
        (c, t if r.random() > 0.05 else None, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None]), r.choice([f"line {r.randrange(texts)}.", "cut off", "", "Why?", None]))
        for c in range(conversations) for t in range(r.randrange(most))
    ]


def test_vectors_are_few_and_normalised():
    t = cr.tables()
    assert len(t.vectors) < 100 and all(min(v) == 0 for v in t.vectors)
    assert t.block.shape == (len(t.vectors), cr.SYMBOLS**cr.BLOCK)


@pytest.mark.parametrize("seed", range(4))
def test_edits_of_random_conversations(seed):
    r = random.Random(seed)
    for _ in range(300):
        said = [(r.choice(["user", "assistant", "system", "tool", ""]), r.choice(["a.", "b!", "c", "", f"{r.random()}."])) for _ in range(r.randrange(14))]
        faults, cost, audit, lines = cheapest(said)
        got = cr.repair([(None, *s) for s in said])
        assert got[5:] == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_odd_rows(spark):
    assert rows_of(cr.audit(spark.createDataFrame(ODD, SCHEMA))) == brute(ODD)


@pytest.mark.parametrize("partitions", [1, 7])
def test_many_conversations(spark, partitions):
    rows = many(3, 150, 20)
    assert rows_of(cr.audit(spark.createDataFrame(rows, SCHEMA).repartition(partitions))) == brute(rows)


def test_long_conversations_in_segments(spark):
    """A conversation with most of all rows, cut into many segments over all partitions."""
    rows = many(5, 12, 25) + [(99, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 170}" + "." * (t % 5 > 0)) for t in range(700)]
    assert rows_of(cr.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), segment_rows=11)) == brute(rows)


def test_repeated_row_of_a_hot_conversation(spark):
    rows = [(1, 2, "user", "same.")] * 400 + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    assert rows_of(cr.audit(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", seg long, pos string, rows int")
    assert cr.audit(df).collect() == []
    rows = [r + (1, "x", 2) for r in many(8, 9, 6)]
    assert rows_of(cr.audit(spark.createDataFrame(rows, SCHEMA + ", seg long, pos string, rows int"))) == brute([r[:4] for r in rows])


def test_all_rows_dropped(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert rows_of(cr.audit(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA))) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_equals_brute_force_and_sql(spark, sf_dir, duck_docs):
    from indicata.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.op13_conversations(spark, sf_dir)) == brute(rows)
    sql = duck_docs.sql(queries.ORACLE_SQL["op13_conversations"])
    assert sorted(sql.fetchall(), key=repr) == brute(rows) and sql.columns == queries.op13_conversations(spark, sf_dir).columns


def test_sql_of_random_conversations(spark):
    import duckdb

    rows = many(21, 120, 12)
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [list(r) for r in rows])
    assert sorted(con.sql(cr.oracle_sql()).fetchall(), key=repr) == brute(rows)
