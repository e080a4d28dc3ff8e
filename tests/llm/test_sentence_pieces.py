"""SentencePiece ids by backtracking against the library."""

import hashlib
import random

import pyarrow as pa
import pytest
from helpers import no_docs, odd_docs, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from stepforge.llm import queries, sentence_pieces

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentence_pieces.Pieces(PATH)


def check(model, texts):
    assert model.encode(pa.array(texts, pa.string())).to_pylist() == [model.processor.encode(x or "") for x in texts]


def test_odd_texts(model):
    check(model, ["", None, " ", "   a", "a  b", " " * 40, "\n", "\t\ta", "a b", "▁", "▁▁ ▁", "ﬁ", "é", "\x00a", "<s>",
                  "<0x0A>", "漢字𠀀", "a ", "aaaaaaa" * 50, "🙂🙂", "1234567890.,;", " x"])


def test_long_parts_without_a_border(model):
    check(model, ["a" * 100_000, "ab" * 30_000, " " * 5_000])


def test_pieces_side_by_side(model):
    rnd, vocabulary = random.Random(3), list(model.ids)
    check(model, ["".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 12))) for _ in range(3000)])


@settings(deadline=None, max_examples=200)
@given(text=st.text(alphabet="abeinrst hlo.\n1é▁", max_size=80))
def test_any_text(model, text):
    check(model, [text])


def test_backtracking_gives_what_merging_gives(model):
    rnd = random.Random(5)
    for _ in range(500):
        text = " " + "".join(rnd.choice("aehilnorst ") for _ in range(rnd.randint(1, 40)))
        assert model.segment(text) == model.merged(text)


def test_memo_may_be_emptied_at_any_time(model, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MEMO_PARTS", 3)
    check(model, ["some words of a text with other words", "words of a text"] * 3)


def test_a_model_that_changes_texts_is_refused(model):
    class Other:
        def __getattr__(self, name):
            return getattr(model.processor, name)

        def normalize(self, text):
            return text.lower().strip()

    with pytest.raises(ValueError):
        sentence_pieces._check(Other())


def expected(rows, processor):
    out = []
    for doc_id, text in rows:
        ids = processor.encode(text or "")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(processor.decode(ids))))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, model):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op13_sentence_pieces"](spark, SF).collect()), key=str)
    assert got == expected(rows, model.processor)


def test_odd_rows_and_empty_tables(spark, model):
    run = lambda docs: sentence_pieces.digests(sentence_pieces.decode(sentence_pieces.encode(docs, PATH), PATH))
    got = sorted((tuple(r) for r in run(odd_docs(spark)).collect()), key=str)
    assert got == expected([r[:2] for r in odd_rows()], model.processor)
    assert run(no_docs(spark)).count() == 0
