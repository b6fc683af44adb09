"""Texts of new pieces are encoded whole, with the same ids."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from commentscope.llm import packing


def test_texts_of_new_pieces_leave_a_warm_cache_alone(monkeypatch):
    monkeypatch.setattr(packing, "WARM_CACHE_BYTES", 20_000)
    fast = packing.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    packing._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken")).forget()
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(3)

    def junk(between):
        return between.join(
            "".join(draw.choices("abcdeé'.,1日", k=draw.randint(1, 12))) + draw.choice(["", "\n", ",", "'s"])
            for _ in range(60)
        )

    held = []
    for _ in range(150):
        for between in (" ", "  ", " 　"):
            text = junk(between)
            ids = slow.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(fast.encode(text), "<u4").tolist() == ids, text
        held.append(len(fast._known) + len(fast._behind))
    assert held[-1] == held[50] < 2000
    common = " ".join(list(fast._behind)[:50])
    assert fast._behind.serves(common.split(" ")[1:])
    packing._encoding(public_tokenizers.path("byte_bpe_50k.tiktoken")).forget()
