"""Units of letters go to the merges at once; ids are those of the library."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from footfall.llm.queries import TOKENIZER
from footfall.llm.tokenbin import library_encoder


def test_ids_of_letters_and_others():
    path = public_tokenizers.path(TOKENIZER)
    encode, _ = library_encoder(path)
    library = Tokenizer.from_file(path)
    texts = ["", " ", "  ", "word", " word", "Größe élan naïve", "words, and 12 more's\n x", "don't I'll", "日本語 한국어 ªº ʰ",
             "a b  c", "<|endoftext|> x<|endoftext|>y", "tail ", "\tword", "x² Ⅷ ½", "éa ", None]
    got = [x.tolist() for x in encode(pa.array(texts, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_letters_skip_the_pattern(monkeypatch):
    from footfall.llm import tokenbin
    from footfall.llm.bpe import merge_list

    path = public_tokenizers.path(TOKENIZER)
    asked = []

    class Pattern:
        def findall(self, unit):
            asked.append(unit)
            return merge_list.__wrapped__(path).pattern.findall(unit)

    merges = merge_list.__wrapped__(path)
    merges.pattern = Pattern()
    monkeypatch.setattr(tokenbin, "merge_list", lambda _: merges)
    monkeypatch.setattr(tokenbin, "_ENCODERS", {})
    encode, _ = tokenbin.library_encoder(path)
    encode(pa.array(["some plain words größer end."]))
    assert asked == [" end."]
