"""Quality rules: counts against plain Python, SQL, odd rows and other threshold tables."""

import re
from collections import Counter

from indicata.llm import quality_rules as qr

PROSE = "The cat sat on the mat, and the dog of the house went with it to a field by the river. "


def base(text):
    text = text or ""
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def counts(df):
    return {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()}


def distinct_words(n):
    return " ".join(f"the{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n))


TEXTS = [
    None, "", " \t\x0b\r\n", "one", "a b", "a b c", "a b c a b c", "a b c d a b c x a b c", "x " * 60, "a a a a",
    "line\nline\n\n \n line\nline ", "# * $ % & | < > end\n#", "été çà là ßtraße " * 3, "😀 😀😀 a b " * 20,
    PROSE * 2, PROSE + distinct_words(80), distinct_words(70).upper(), "\n".join(["- item of the list"] * 30), "x" * 300_000, "a b " * 50_000, distinct_words(500) + "\n" + PROSE + "\r\n" + PROSE,
]


def test_counts_of_odd_texts(make_docs):
    assert counts(qr.decisions(make_docs(TEXTS))) == {i: base(t) for i, t in enumerate(TEXTS)}


def test_sql_gives_the_same_rows(spark, duck_docs, sf_dir):
    from indicata.llm import queries

    got = queries.op11_quality_rules(spark, sf_dir)
    want = duck_docs.sql(queries.ORACLE_SQL["op11_quality_rules"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_verdicts(make_docs):
    clean = PROSE + distinct_words(20) + ".\nIn the evening, a storm came to the valley, and for an hour there was no light in this house. The rest of that night is not told in any book by the people of the village, who were all on their way to a far town.\n"
    bad = {
        "symbols": re.sub(" ", " *** ", clean),
        "capitals": clean.upper(),
        "no stop words": " | ".join(f"qz{chr(97 + i % 26)}{chr(97 + i // 26)}rt" for i in range(100)).replace("|", "."),
        "numbers": " ".join(str(i * 7919) for i in range(80)) + " the of and",
        "repeated": clean.split(".")[0] * 10,
        "short": "The end of the story.",
    }
    got = {r.doc_id: r.kept for r in qr.decisions(make_docs([clean, *bad.values()])).collect()}
    assert got == {0: True, **{i + 1: False for i in range(len(bad))}}, list(bad)


def test_rows_pass_through_whatever_their_names(spark):
    names = "doc_id long, text string, kept string, row int, w int, n_words string, `a b` int"
    rows = [(None, PROSE + distinct_words(60), "k", 1, 2, "n", 3), (None, None, "k", 1, 2, "n", 3)] * 2
    df = spark.createDataFrame(rows, names)
    kept = qr.keep_good(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [rows[0]] * 2
    assert qr.decisions(df).count() == 4
    assert qr.decisions(df.limit(0)).collect() == []


def test_a_threshold_table_of_ones_own(spark, make_docs):
    table = spark.createDataFrame([("n_stop_words", "n_words", None, 100), ("word_chars", "n_words", 3_000, None)], "value string, per string, low long, high long")
    rules = qr.rules_from(table)
    assert rules == (qr.Rule("n_stop_words", "n_words", None, 100), qr.Rule("word_chars", "n_words", 3_000, None))
    docs = make_docs([PROSE + distinct_words(20), distinct_words(90)])
    assert {r.doc_id: r.kept for r in qr.decisions(docs, rules).collect()} == {0: False, 1: True}
    plan = qr.decisions(docs, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
