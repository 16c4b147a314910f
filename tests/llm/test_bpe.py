import random

import public_tokenizers
from tokenizers import Tokenizer

from ebbline.llm import bpe
from tests.llm.cases import awkward, documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = list("abcXYZ019 '.,<|>\n\t\r\x0b\x1c\x85\xa0 　éÉÀßΣσςİıſ") + ["́", "日", "😀", "<|endoftext|>", "'s", "'LL", "½", "Ⅷ", "ﬁ", "한", "\x00"]


def test_same_counts_as_the_library(spark):
    library = Tokenizer.from_file(PATH)
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    for df in (awkward(spark), documents(spark)):
        texts = [r.text for r in df.select("text").collect()]
        rows = bpe.token_counts(df, PATH).collect()
        assert [r.n_tokens for r in rows] == [count(t) for t in texts]
        assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in texts]
        assert [r.over_limit for r in rows] == [count(t) > 2048 for t in texts]
    rng, merges = random.Random(1), bpe.merges(PATH)
    for _ in range(4_000):
        text = "".join(rng.choices(ODD, k=rng.randrange(15)))
        assert merges.count(text) == count(text), text
    assert bpe.token_counts(empty(spark), PATH).count() == 0
