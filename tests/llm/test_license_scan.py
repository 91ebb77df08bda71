import re

import duckdb

from hourglass.llm.license_scan import ORACLE_OP6, PHRASES, TEMPLATES, THRESHOLD, WORD, _template_words, scan_licenses
from tests.llm.helpers import ascii_lower

LINES = [t for _, t in TEMPLATES]
TEXTS = [None, "", " \n\t", "MIT License", "mit\nlicense MIT license", "Licensed under CC BY-NC 4.0.", "the mit", "mit license mit license mit license",
         "Released under the mit licence", "This work is licensed under the GNU General Public License, version 3.",
         "licensed under cc by nc 4", "licensed under cc by", "x " * 3000 + LINES[1] + " y" * 3000, "x " * 41 + LINES[4] + "\n" + LINES[7],
         "cc " + "x " * 200 + "by nc 4 0 licensed under", "general public  licenſe general-public license", "é" * 10 + " apache_license"]


def brute(text):
    low = ascii_lower(text or "")
    words = re.findall(WORD, low)
    places, base, labels, best = [], set(), set(), 0.0
    for label, phrase in PHRASES:
        p = phrase.split(" ")
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    longest = max(len(re.findall(WORD, t)) for _, t in TEMPLATES)
    for line in low.split("\n"):
        ws = re.findall(WORD, line)
        for s in range(0, max(len(ws) - longest - 1, 0) + 1, longest):
            block = set(ws[s:s + 2 * longest])
            for label, t in TEMPLATES:
                t = set(_template_words(t))
                if 100 * len(t & block) >= THRESHOLD * len(t):
                    labels.add(label)
                    best = max(best, len(t & block) / len(t))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), 1.0 if places else best)


def test_matches_brute_force(spark):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, labels string, n_words int")
    got = {r["doc_id"]: tuple(r)[1:] for r in scan_licenses(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_null_keys_repeated_rows_and_empty_table(spark):
    schema = "doc_id long, text string"
    rows = [(None, LINES[0]), (None, "x"), (7, LINES[3]), (7, LINES[3]), (7, "x")]
    got = sorted((r["doc_id"] or 0, r["labels"]) for r in scan_licenses(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, ""), (0, "mit"), (7, ""), (7, "cc-by-nc"), (7, "cc-by-nc")]
    assert scan_licenses(spark.createDataFrame([], schema)).collect() == []


def test_no_python_in_the_plan(spark, monkeypatch):
    monkeypatch.setattr("hourglass.llm.license_scan.checkpoint", lambda df: df)  # the plan as a whole
    plan = scan_licenses(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_wrapped_copies_of_every_template(spark):
    texts = []
    for _, t in TEMPLATES:
        words = t.split()
        for width in (1, 3, 6, 11):
            rows = [" ".join(words[i:i + width]) for i in range(0, len(words), width)]
            texts.append("x " * 50 + "\n * " + "\n * ".join(rows) + "\n" + "y " * 50)
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in range(len(texts))] == [label for label, _ in TEMPLATES for _ in range(4)]
    assert all(r["score"] == 1.0 for r in got.values())


def test_words_of_a_short_template_scattered_over_lines_are_no_notice(spark):
    texts = ["Released under the\nApache License\nund mit", "by nc 4\n0 cc licensed"]
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {0: "apache", 1: ""}


def test_confusable_notices_need_the_telling_word(spark):
    texts = {"Released under the Foo License": "", "Released under the Apache License": "apache", "Licensed under CC BY 4.0": "",
             "Licensed under CC BY-SA 4.0": "", "Licensed under the Mozilla License, Version 2.0": "", "released under the MIT licence": "mit",
             "licensed under by-nc 4.0": "cc-by-nc", "mor\u212a " + LINES[3]: "cc-by-nc", "Licensed under the Foo License, Version 2.0 " + LINES[7]: "bsd",
             "This worK is licensed under the GNU General license version 3": ""}
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == dict(enumerate(texts.values()))


def test_sql_states_the_same_rule(spark):
    """Wrapped, scattered and confusable notices, by the query and by its SQL."""
    texts = list(TEXTS)
    for _, t in TEMPLATES:
        words = t.split()
        for width in (1, 2, 5, 9):
            rows = [" ".join(words[i:i + width]) for i in range(0, len(words), width)]
            texts.append("x " * 50 + "\n * " + "\n * ".join(rows) + "\n" + "y " * 50)
        texts += [" ".join(words[1:]), "\n".join(words[:-1]), "z\n" + " ".join(words[::-1]), "a " * 70 + " ".join(words[2:]) + "\n" + words[0]]
    texts += ["Released under the Apache License", "Licensed under CC BY 4.0", "Released under the\nApache License\nund mit",
              "Released under the Foo License\nmit", "Released\nunder the MIT\nLicense"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = con.sql(ORACLE_OP6)
    got = scan_licenses(df).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
