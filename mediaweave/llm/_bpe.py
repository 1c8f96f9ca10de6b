"""Token ids of a byte-level BPE vocabulary, with words remembered between texts.

The ids are those of `tokenizers` for the vocabulary file, special tokens not added. Texts whose white space is single spaces and line
feeds between words, which are nearly all, are cut before each white space character: the vocabulary's pattern never
joins across such a place, so a text's ids are its words' ids on end. Other texts are encoded whole.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: Words remembered; at the bound all are forgotten, so a worker's memory is bounded.
REMEMBERED = 300_000
#: Longest word, in characters, that is remembered.
LONGEST = 64


class Encoder:
    def __init__(self, path: str, ranks: str | None):
        self.whole = Tokenizer.from_file(path)
        names = [t["content"] for t in json.load(open(path, encoding="utf-8")).get("added_tokens", [])]
        self.special = names
        pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))} if ranks else None
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={}) if pairs else None
        self.lead: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        ids = self.fast.encode_ordinary(text) if self.fast else self.whole.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def _missing(self, known: dict[str, bytes], word: str, text: str) -> bytes:
        got = self._ids(text)
        if len(word) <= LONGEST:
            if len(known) >= REMEMBERED:
                known.clear()
            known[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if " ".join(text.split()) != text.replace("\n", " "):
            return self._ids(text)
        out: list[bytes] = []
        feed = None
        lead, bare = self.lead, self.bare
        for line in text.split("\n"):
            words = line.split(" ")
            if feed is None:
                feed = self._missing(bare, "\n", "\n") if "\n" not in bare else bare["\n"]
            else:
                out.append(feed)
            w = words[0]
            out.append(bare.get(w) or self._missing(bare, w, w))
            for w in words[1:]:
                out.append(lead.get(w) or self._missing(lead, w, " " + w))
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One per worker process, so that words stay remembered between tasks."""
    return Encoder(path, ranks)
