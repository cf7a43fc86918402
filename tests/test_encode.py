import numpy as np
import pytest
from pyspark.sql import functions as F

from simsearch.operators import encode
from simsearch.operators.encode import HashingEncoder, LazyEncoder, encode_papers


def lengths_encoder():
    """Text length and word count, to see what reaches an encoder; a class workers can unpickle."""

    class Lengths:
        dim = 2

        def encode(self, texts):
            import numpy

            return numpy.array([[len(t), len(t.split())] for t in texts], dtype=float)

    return Lengths


Lengths = lengths_encoder()


def test_vectors_have_unit_length_and_repeat(papers):
    first = {r["paper_id"]: r["embedding"] for r in encode_papers(papers, HashingEncoder(32)).collect()}
    again = {r["paper_id"]: r["embedding"] for r in encode_papers(papers.repartition(7), HashingEncoder(32), 13).collect()}
    assert first == again and len(first) == 1000
    assert all(len(v) == 32 and abs(np.linalg.norm(v) - 1) < 1e-5 for v in first.values())


def test_whole_texts_reach_the_encoder(spark):
    rows = [(1, "word " * 20_000), (2, ""), (3, None)]
    papers = spark.createDataFrame(rows, "paper_id bigint, abstract string")
    got = {r["paper_id"]: r["embedding"] for r in encode_papers(papers, Lengths()).collect()}
    assert got[1] == pytest.approx([100_000 / np.hypot(100_000, 20_000), 20_000 / np.hypot(100_000, 20_000)])
    assert got[2] is None and got[3] is None
    assert encode.count_empty(encode_papers(papers, Lengths())).first()[0] == 2


def test_texts_without_words_have_no_vector(spark):
    papers = spark.createDataFrame([(1, "  ... !!"), (2, "two words")], "paper_id bigint, abstract string")
    got = {r["paper_id"]: r["embedding"] for r in encode_papers(papers, HashingEncoder(8)).collect()}
    assert got[1] is None and got[2] is not None


def test_a_lazy_encoder_is_made_in_the_worker(papers):
    lazy = LazyEncoder(Lengths, 2)
    assert encode_papers(papers, lazy).where(F.size("embedding") == 2).count() == 1000
    assert lazy._made is None


def test_encoder_must_declare_its_dimension(papers):
    class Unknown(Lengths):
        dim = None

    with pytest.raises(ValueError, match="fixed dimension"):
        encode_papers(papers, Unknown())


def test_columns_can_be_carried_along(papers):
    got = encode.encode_column(papers, HashingEncoder(8), "paper_id", keep=("title",)).first()
    assert got["title"] == f"Paper {got['paper_id']}"


def test_remembered_words_stay_bounded_inside_a_text(monkeypatch):
    monkeypatch.setattr(encode, "MAX_CACHED_WORDS", 50)
    text = " ".join(f"word{i % 300}" for i in range(900))
    bounded = HashingEncoder(16)
    got = bounded.encode([text, text])
    assert len(bounded._slots) <= 50
    monkeypatch.setattr(encode, "MAX_CACHED_WORDS", 10_000)
    assert (got == HashingEncoder(16).encode([text, text])).all()
