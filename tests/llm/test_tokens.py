"""Chunk-wise encoding equals whole-text encoding by the library."""

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from trackline.llm.tokens import BatchEncoder

TEXTS = ["", " ", "  ", "a", "Hello, world", "a  b   c", " lead and trail ", "x\n\ny \n z\t", "it's they're 'tis O'Neil's",
         "naïve Étion ßtraße ŒUVRE ﬁ", "1234 5a6 a1b2", "<|endoftext|> mid<|endoftext|>dle", "日本語 テキスト 混ぜ", "é ́x",
         "tab\tsep  nbsp em", "a. b, c! (d) [e] {f}", "x" * 3000, "word " * 500, "\x1c odd \x1f ws \x85", "Σίσυφος ΣΑΣ", "emoji 😀 👍🏽!"]


@pytest.mark.parametrize("name,end", [("byte_bpe_50k.json", 0), ("word_bpe_49k.json", 1)])
def test_chunks_equal_whole(name, end):
    ours = BatchEncoder(P.path(name), cache_entries=5)
    lib = Tokenizer.from_file(P.path(name))
    lib.encode_special_tokens = True
    for texts in (TEXTS, TEXTS[::-1], TEXTS[:1], [TEXTS[5]]):
        ids, at = ours.encode(texts, end)
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids + [end], repr(t)


def test_no_texts():
    ids, at = BatchEncoder(P.path("byte_bpe_50k.json")).encode([], 0)
    assert len(ids) == 0 and at.tolist() == [0]
