"""The packing's ids against the tokenizer's on random text of all Unicode categories, and its output names."""

import random
import sys
import unicodedata
from collections import defaultdict

import numpy as np

from folioloom.llm import packing


def test_ids_on_random_unicode():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY[0]))
    encode = packing.token_encoder(*map(public_tokenizers.path, packing.VOCABULARY))
    kinds = defaultdict(list)
    for c in range(0, sys.maxunicode + 1, 7):
        if not 0xD800 <= c <= 0xDFFF:
            kinds[unicodedata.category(chr(c))].append(chr(c))
    for c in map(chr, range(0x250)):
        kinds[unicodedata.category(c)].append(c)
    rng = random.Random(11)
    common = [" ", "  ", "\n", "\t", "'s", "'LL", "don't", "the", " of", "12", "\u00a0", "\u2009", "\r\n"]
    for _ in range(1500):
        parts = [rng.choice(common) if rng.random() < 0.4 else rng.choice(kinds[rng.choice(list(kinds))]) for _ in range(rng.randint(1, 25))]
        text = "".join(parts)
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_a_key_named_like_an_output(spark):
    out = packing.pack_documents(spark.createDataFrame([(1, "a b", 2)], "start long, text string, tier int"), key="start")
    assert out.columns[:3] == ["start", "_start", "length"] and out.first()["start"] == 1
