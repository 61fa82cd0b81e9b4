from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillwatch.llm import alignment, catalog, pieces


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers

    a = Tokenizer.from_file(public_tokenizers.path(alignment.A_FILE))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=pieces.model_path())


def spans(libraries, text):
    """(start, end, id) of both sides' tokens, byte by byte; none where a side spells other bytes."""
    a, b = libraries
    raw = (" " + text).encode()
    letters = alignment._byte_of_letter()
    sides = [
        [(own, bytes(letters[letter] for letter in a.id_to_token(own))) for own in a.encode(" " + text, add_special_tokens=False).ids],
        [(own, bytes([int(piece[3:5], 16)]) if b.is_byte(own) else piece.replace("▁", " ").encode())
         for own in b.encode(text) for piece in [b.id_to_piece(own)]]]
    found = []
    for side in sides:
        if b"".join(token for _, token in side) != raw:
            return [], []
        at, own = 0, []
        for number, token in side:
            own.append((at, at + len(token), number))
            at += len(token)
        found.append(own)
    return found


def brute(libraries, rows):
    measured, holds = [], Counter()
    for doc_id, text in rows:
        a, b = spans(libraries, text) if text else ([], [])
        links = [(x[2], y[2]) for x in a for y in b if max(x[0], y[0]) < min(x[1], y[1])]
        holds.update(set(links))
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = []
        for start, end in zip([0, *ends], ends):
            inside = [",".join(str(own[2]) for own in side if start < own[1] <= end) for side in (a, b)]
            groups.append("|".join(inside))
        measured.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (own, _), n in holds.items():
        most[own] = max(most[own], n)
    return [
        (doc_id, n_a, n_b, n_groups, len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
         sum(holds[own] == most[own[0]] for own in links), sum(holds[own] for own in links))
        for doc_id, n_a, n_b, n_groups, links, groups in measured]


TEXTS = [
    None, "", " ", "   ", "a", "<|endoftext|> <s></s> x", "a▁b is not spelled", "▁", "naïve café 字字 \U0001f600x", "\0\n\t  a  b",
    "It's 42 o'clock, isn't it?", "tokenization unbelievably antidisestablishmentarianism", " leading and  double  blanks ", "x" * 300,
]


def sample(chance, n):
    words = "the of tokenization été 字 <0x41> x1 isn't \U0001f600 unhappily ... \n".split(" ")
    return [" ".join(chance.choices(words, k=chance.randrange(1, 30))) for _ in range(n)]


def check(spark, libraries, rows, partitions=3):
    docs = spark.createDataFrame([(*row, 1, "y") for row in rows], "doc_id long, text string, pair int, block string")
    found = alignment.report(docs.repartition(partitions))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(libraries, rows), key=repr)


def test_report_like_a_plain_version(spark, libraries):
    chance = random.Random(1)
    rows = list(enumerate([*TEXTS, *sample(chance, 60)])) + [(None, "the the"), (7, "again"), (7, "again")]
    check(spark, libraries, rows)


def test_parts_and_blocks_change_nothing(libraries, monkeypatch):
    """Tasks run in processes of their own, so the parts of a text are tried here, without Spark."""
    import pyarrow as pa

    chance = random.Random(2)
    texts = [*TEXTS, *sample(chance, 120), " ".join(sample(chance, 40)), "one ▁ two " * 30 + "three"]
    words = alignment._loaded(None)

    def found():
        return [
            (own.row, own.n.tolist(), own.digest.hexdigest(), *(part.tolist() for part in own.links()))
            for own in alignment._documents(words, pa.array(texts))]

    whole = found()
    monkeypatch.setattr(alignment, "PART", 10)
    monkeypatch.setattr(alignment, "ALIGNED", 30)
    assert found() == whole and len(whole) > 120
    for text in texts:
        assert "".join(alignment.parts_of(text or "")) == (" " + text if text else "")


def test_many_documents_in_many_blocks(spark, libraries):
    rows = list(enumerate(sample(random.Random(3), 150)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert alignment.blocks(docs).where("pairs IS NOT NULL").count() == 4
    assert alignment.blocks(docs, most=200).where("pairs IS NOT NULL").count() > 8
    for most in (1, 200):
        assert sorted(map(tuple, alignment.report(docs, most=most).collect())) == sorted(brute(libraries, rows))


def test_byte_level_ids_like_the_library(libraries):
    words = alignment._loaded(None)
    texts = [f"a{chr(code)}a1{chr(code)}1!{chr(code)}! {chr(code)} x  {chr(code)}{chr(code)} '{chr(code)}"
             for code in range(0, 0x30000, 7) if not 0xD800 <= code < 0xE000]
    texts += [text for text in TEXTS if text] + [" " * 500_000 + "x", "\n" * 400_000]
    for text, (a_ids, _) in zip(texts, [own or ([], 0) for own in words.encode([" " + text for text in texts])]):
        assert not a_ids or a_ids == libraries[0].encode(" " + text, add_special_tokens=False).ids


def test_groups_spell_the_text(spark, libraries):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    words = alignment._loaded(None)
    spelled = defaultdict(lambda: [b"", b""])
    for row in alignment.groups(docs).orderBy("doc_id", "number").collect():
        sides = b"".join(words.a_bytes[own] for own in row["a_ids"]), b"".join(words.b_bytes[own] for own in row["b_ids"])
        assert sides[0] == sides[1] != b""
        spelled[row["doc_id"]][0] += sides[0]
    assert {at: own[0] for at, own in spelled.items()} == {
        at: (" " + text).encode() for at, text in enumerate(TEXTS) if text and "▁" not in text}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.report(docs).count() == alignment.groups(docs).count() == 0
    nothing = alignment.report(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, nothing), key=repr) == [(1, 0, 0, 0, 0, "", 0, 0), (None, 0, 0, 0, 0, "", 0, 0)]


def test_query_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, n_a string").write.parquet(str(tmp_path / "documents.parquet"))
    assert set(catalog.op13_alignment(spark, str(tmp_path)).columns) == {
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"}
