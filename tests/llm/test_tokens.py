import hashlib
import random

import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
import public_tokenizers  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from plumbline.llm.bpe import Encoder, encode_decode, encode_words  # noqa: E402
from plumbline.llm.bytelevel import vocabulary  # noqa: E402
from plumbline.llm.tokencount import Transducer, count_batch, count_tokens, cuts, scan  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", "a", " ", "  ", "\n\n a", "it's we'll 'r 're're 'll' 's's l'l", "  \t\n x", "<|endoftext|>a <|endoftext|><|endoftext|>  ", "x  <|endoftext|> y", "日本語のテキスト。 漢字", "😀😀 👍🏽é́", "a\u00a0b \u00a0 c", "\u3000 x", "x'" * 50, "1234567890 12²Ⅷ", "\x1c\x1d a\x1f", "\x85\x85x", "'", "''s", "'lx", "don't ' s", "word" * 3000, "aaaaaaaaaaaaaaa", " " * 5000]
PARTS = ["a", "b", "the", " ", "  ", "\n", "'", "'s", "'ll", "r", "1", "23", "!", "é", "ß", "日", "\u00a0", "😀", "ing", "ation", "\t", "l", "v", "e", "<|endoftext|>"]
ENCODER, MACHINE = Encoder(PATH), Transducer(PATH)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=40))
def test_like_the_library(parts):
    text = "".join(parts)
    joined, n, back = next(ENCODER.batch([text]))
    want = ids(text)
    assert joined == ",".join(map(str, want)) and n == len(want)
    assert back == LIBRARY.decode(want, skip_special_tokens=False)
    assert count_batch(pa.array([text]), MACHINE).tolist() == [len(want)]


def test_odd_texts_in_chunks_of_any_size():
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300))) for _ in range(200)]
    want = [len(ids(t)) for t in texts]
    for size in (1, 7, 64, 512):
        assert count_batch(pa.array(texts), MACHINE, size).tolist() == want
    small = Transducer(PATH, most=50)  # tables are emptied between batches
    assert [count_batch(pa.array([t]), small).tolist()[0] for t in texts] == want


def test_pair_index_against_the_plain_definition():
    rng = random.Random(2)
    vocab = vocabulary(PATH)
    words = [bytes(rng.choice(b"aabcdeinot \xc3\xa9") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    assert encode_words(words, vocab) == [vocab.encode_word(w) for w in words]


def test_chunks_compose():
    import numpy as np

    counts, owner = np.array([1, 2, 3, 4, 5]), np.array([0, 0, 0, 2, 2])
    assert scan(counts, owner).tolist() == [1, 3, 6, 4, 9]
    data = np.frombuffer(b"ab cd ef gh", np.uint8)
    b, e, o = cuts(data, np.array([0, 5]), np.array([5, 11]), 2)
    assert (b.tolist(), e.tolist(), o.tolist()) == ([0, 2, 5, 8], [2, 5, 8, 11], [0, 0, 1, 1])


def test_frames(spark):
    rows = [(1, "It's a test."), (1, "It's a test."), (None, "x"), (2, None), (3, ""), (4, "long text " * 30000), (5, "<|endoftext|>")]
    df = spark.createDataFrame([(i, t, 7, "c") for i, t in rows], "doc_id long, text string, n_tokens int, ids string").repartition(2)
    texts = sorted([(i, t or "") for i, t in rows], key=str)
    got = sorted([tuple(r) for r in encode_decode(df).collect()], key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted([(i, len(ids(t)), sha(",".join(map(str, ids(t)))), sha(t)) for i, t in texts], key=str)
    full = {r.doc_id: r for r in encode_decode(df.where("doc_id = 1"), with_ids=True).collect()}[1]
    assert full.ids == ids("It's a test.") and full.decoded == "It's a test."
    counts = sorted([tuple(r) for r in count_tokens(df, limit=100).collect()], key=str)
    assert counts == sorted([(i, len(t.encode()), len(ids(t)), len(ids(t)) > 100) for i, t in texts], key=str)
    assert encode_decode(df.limit(0)).count() == count_tokens(df.limit(0)).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        vocabulary(public_tokenizers.path("word_bpe_49k.json"))
