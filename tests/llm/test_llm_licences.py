"""Licence notices in other forms than one line: wrapped, inside longer lines, several in a text."""

import random

import duckdb
import pyarrow as pa
import pytest

from stockyard.llm import licenses, oracle

GPL = next(t for name, t in licenses.TEMPLATES if name == "GPL-3.0" and t.startswith("This program"))


def wrapped(text, width, lead=""):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) > width:
            lines.append(lead + line.strip())
            line = ""
        line += w + " "
    return "\n".join([*lines, lead + line.strip()])


def noise(rng, n):
    return " ".join(rng.choice(["red", "the", "of", "file", "software", "license", "blue", "run", "any", "use"]) for _ in range(n))


def scan(spark, texts):
    return licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()


@pytest.mark.parametrize(
    "line, name",
    [
        ("This file is licensed under the MIT license", "MIT"),
        ("// Licensed under the MIT License.", "MIT"),
        ("you may not use this file except in compliance with the License.", "Apache-2.0"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
        ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0"),
        (GPL, "GPL-3.0"),
    ],
)
def test_usual_notices(spark, line, name):
    assert [(r["line"], r["license"]) for r in scan(spark, [line])] == [(1, name)]


def test_wrapped_and_inner_notices(spark):
    rng = random.Random(4)
    before = "\n".join(noise(rng, 12) for _ in range(30))
    texts = [
        f"{before}\n{wrapped(GPL, 90, ' * ')}\n{before}",
        f"{noise(rng, 50)} {GPL} {noise(rng, 50)}",
        f"{before}\n{wrapped(licenses._APACHE, 70, '# ')}\n{before}\n{wrapped(licenses._MIT[0], 60)}\n{before}",
        noise(rng, 3000),
    ]
    got = {}
    for r in scan(spark, texts):
        if r["dice"] > 0.95:
            got.setdefault(r["doc_id"], {})[r["line"]] = r["license"]
    assert got[0][31] == "GPL-3.0" and got[1] == {1: "GPL-3.0"} and 3 not in got
    assert got[2][31] == "Apache-2.0" and "MIT" in got[2].values()


def test_forms_match_sql(spark):
    rng = random.Random(11)
    texts = [None, "", "mit", "\n\n", wrapped(GPL, 40) * 3]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = rng.choice(licenses.TEMPLATES)[1].split()
            for _ in range(rng.randint(0, len(w) // 6)):
                w[rng.randrange(len(w))] = rng.choice(["red", "software", "the"])
            parts += [noise(rng, rng.randint(0, 30)), wrapped(" ".join(w), rng.choice([30, 60, 10_000]), rng.choice(["", "# "]))]
        texts.append(rng.choice([" ", "\n"]).join(parts))
    texts += texts[-3:]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}))
    want = con.sql(oracle.oracle_sql()["op4_license_scan"]).fetchall()
    assert len(want) > 40 and sorted(map(tuple, scan(spark, texts))) == sorted(want)


def test_very_long_and_repeated_rows(spark):
    rng = random.Random(2)
    long = "\n".join(noise(rng, 20) + " " + wrapped(GPL, 80) for _ in range(300))
    docs = spark.createDataFrame([(1, long, "x"), (1, long, "y")], "doc_id long, text string, license string")
    got = licenses.scan(docs).where("dice > 0.99").groupBy("line").count().collect()
    assert len(got) == 300 and {r["count"] for r in got} == {2}
