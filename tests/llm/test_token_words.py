"""Words that the cached tokenizer looks up, and grammars packed from them."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from basketgraph.llm import common, op3_repair


def test_capitals_and_punctuation_are_not_met_as_new_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, plain = common.CachedTokenizer(path, space_joins_next=False), Tokenizer.from_file(path)
    text = "river River RIVER river, river. River; straße Straße, (river"
    assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    # river, straße, the three tails, and "(river", which is no word with a tail
    assert sorted(own.known.to_pylist()) == sorted(["river", "straße", ",", ".", ";", "(river"])


def test_parted_words_equal_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, plain = common.CachedTokenizer(path, space_joins_next=False), Tokenizer.from_file(path)
    rng = np.random.default_rng(5)
    signs = [*"abXYZ .,;!?'-\"()<>@_`~01\n\t", *"éÀÿŸßẞİıŉǅÐſ×÷ªº²中한😀ΣσςД", "́", "̱", "̸", "K", "़", "क़", "'s", "'ll", "</w>", "H̱", "the", "ÜBER"]
    texts = ["".join(signs[i] for i in rng.integers(0, len(signs), rng.integers(0, 25))) for _ in range(4000)]
    texts += [f"{a}{chr(c)}{b}" for c in range(0x21, 0x250) for a in ("", "E") for b in ("", ",", "x")]
    ids, sizes = own.encode_many(texts)
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert got.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_other_rules_keep_whole_chunks():
    own = common.CachedTokenizer(public_tokenizers.path("byte_bpe_50k.json"), space_joins_next=True)
    assert own.word_ends is None
    own.encode("River river,")
    assert sorted(own.known.to_pylist()) == [" river,", "River"]


def test_wide_symbols_and_runs_come_back():
    rng = np.random.default_rng(6)
    wide = np.tile(np.arange(70_000, dtype=np.uint32), 8)  # more symbols than fit 16 bits
    runs = np.repeat(rng.integers(0, 50, 3000), rng.integers(1, 9, 3000)).astype(np.uint32)
    for ids in ([wide], [runs, runs[:1], runs[5:900]]):
        shard = op3_repair.Shard(op3_repair.pack_shard(list(range(len(ids))), ids))
        assert len(shard.rules) > 0
        assert all((shard.document(k) == x).all() for k, x in enumerate(ids))
