"""The registered queries against their SQL, and the pipeline against a plain version of each stage."""

from __future__ import annotations

import hashlib
import os
import random
import re
from pathlib import Path

import pytest
from tokenizers import Tokenizer as Library

import corpus_pipeline
from test_mixing import water_filled
from test_ngram_join import brute as groups_of
from test_quality import WORD, brute as judged
from tillwatch.llm import bpe, catalog, secret_scan

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@needs_tables
@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = catalog.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.sql(catalog.oracle_sql()[name])
    assert sorted(want.columns) == columns
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(want, key=repr)


@needs_tables
@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_other_queries_return_a_row_for_each(spark, name):
    found = catalog.queries()[name](spark, SF)
    table = "pages" if name.startswith("op1_") else "documents"
    if not name.startswith("op7_"):
        assert found.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    else:
        # The five statements that the documents hold, counted in their texts one by one.
        texts = [row["text"] or "" for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
        statements = "GNU General Public License|CC BY-NC|MIT License|Apache License|All rights reserved"
        assert found.count() == sum(len(re.findall(statements, text)) for text in texts)


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in catalog.queries()] == [f"op{n}" for n in range(1, 14)]


def documents():
    chance = random.Random(9)
    word = lambda: "".join(chance.choice("abcdefgh") for _ in range(chance.randrange(2, 6)))
    rows = [(900, None, "en", "a", 0), (901, "", "en", "a", 0), (902, "too short", "en", "b", 9)]
    for group in range(25):
        base = [word() for _ in range(chance.randrange(18, 90))]
        for _ in range(chance.choice([1, 1, 3, 6])):
            own = base[:]
            if chance.random() < 0.5:
                own[chance.randrange(len(own))] = word()
            if group % 5 == 0:
                own[5] = "password=" + "k3y" * 5
            if group % 7 == 0:
                own = [part + "###" for part in own]
            text = " ".join(own)
            rows.append((len(rows) * 37 % 997, text, "en", chance.choice(["a", "b", "c", None]), len(text)))
    return rows


def placed(row):
    return hashlib.md5(f"{row[0]}/{hashlib.md5(row[1].encode()).hexdigest()}".encode()).hexdigest()


def plain_pipeline(rows):
    rows = [own for own in rows if judged(own[1])["kept"]]
    smallest = {doc_id: component for doc_id, _, component in groups_of([own[:2] for own in rows])}
    rows = [(own[0], secret_scan.redacted(own[1]), own[3]) for own in rows if smallest[own[0]] == own[0]]
    sizes, library, out = {}, Library.from_file(bpe.vocabulary_path()), []
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text))
    targets = water_filled(sizes)
    for source in sizes:
        at = 0
        for doc_id, text, own in sorted(rows, key=placed):
            if own != source:
                continue
            size = len(WORD.findall(text))
            encoded = library.encode(text, add_special_tokens=False)
            ids = b"".join(number.to_bytes(4, "little") for number in encoded.ids)
            decoded = library.decode(encoded.ids, skip_special_tokens=False).encode()
            row = (doc_id, len(encoded.ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
            out += [row] * sum(at + size / 2 + copy * sizes[source] <= targets[source] for copy in range(2))
            at += size
    return sorted(out)


def test_pipeline_like_plain_stages(spark, tmp_path):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert found == plain_pipeline(rows) and len(found) > 20


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "w " * 50, "en", None, 100), (1, "w " * 50, "en", None, 100)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, "").columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, rows, "").count() == rows.count()
