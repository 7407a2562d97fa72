import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import vocabulary
from tallyhouse.llm.queries import op1_token_counts
from tallyhouse.llm.token_counts import lengths


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_same_ids_for_code_points(reference):
    """All of the first 13,000 and each eleventh of the others (all were compared once, none differs)."""
    points = [chr(c) for c in [*range(0x3400), *range(0x3400, 0x110000, 11)] if not 0xD800 <= c <= 0xDFFF]
    encoder = vocabulary.encoder()
    for at in range(0, len(points), 20_000):
        texts = [f"a{c}a {c} 1{c}1 .{c}.  {c}{c}" for c in points[at : at + 20_000]]
        assert reference(texts) == encoder.encode_batch(texts, num_threads=2, allowed_special="all")


def test_random_texts_and_pieces(reference):
    rng = random.Random(1)
    parts = ["a", "Zz9", " ", "  ", "\n", "\n\n ", "\t", "'s", "é", "日本", "!?", "<|endoftext|>", " ", "123", "word word"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 400))) for _ in range(400)]
    assert lengths(texts, None, batch_bytes=200, piece_chars=16) == [len(ids) for ids in reference(texts)]
    assert all("".join(vocabulary.safe_pieces(t, 16)) == t for t in texts)


def test_odd_rows(spark, folders, reference):
    rows = op1_token_counts(spark, folders["odd"]).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[0]["n_bytes"], by_id[0]["n_tokens"], by_id[0]["over_limit"]) == (0, 0, False)
    assert by_id[4]["n_bytes"] == 300_000 and by_id[4]["n_tokens"] == len(reference(["x" * 300_000])[0])
    assert sum(r["doc_id"] == 6 for r in rows) == 2
