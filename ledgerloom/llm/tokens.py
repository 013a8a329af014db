"""Loading and running a tokenizer file in Python workers.

A byte-level BPE encodes each word of its splitting rule on its own, so a worker keeps the ids of words it has met and gives the
library only new ones; texts that the rule below might split otherwise go to the library whole. Either way the ids are the library's.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Outside these characters (ASCII, Latin letters, common punctuation) the rule below may split otherwise than the library.
ODD = re.compile(rf"[^\t\n\r\x20-\x7e¡-©«-¬®-±´¶-¸»¿{LETTERS}×÷‐-‧]")
#: The splitting rule of byte-level BPE, over these characters.
SPLIT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[0-9]+| ?[^ \t\n\r{LETTERS}0-9]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+")


def _by_words(path: str) -> bool:
    """Does the file hold a byte-level BPE whose words are encoded on their own?"""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre, model = d.get("pre_tokenizer") or {}, d.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return bool(plain and model.get("type") == "BPE" and not model.get("dropout") and not d.get("normalizer") and not d.get("truncation") and not d.get("padding"))


class Words(dict):
    """Ids by word. A word that is not there gets an empty array, which is filled before it is read; `older` may still hold it."""

    def __init__(self, older: dict):
        super().__init__()
        self.older, self.new = older, []

    def __missing__(self, word):
        got = self.older.get(word)
        if got is None:
            got = bytearray()
            self.new.append(word)
        self[word] = got
        return got


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. At most `most` words are kept, in two halves: when the newer half is full, it
    replaces the older one, so words that keep coming stay."""

    def __init__(self, path: str, most: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.words = Tokenizer.from_file(path), most, Words({})
        self.by_words = _by_words(path)
        added = [re.escape(a.content) for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None

    def library(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [struct.pack(f"<{len(i)}I", *i) for i in ids]

    def whole(self, text: str) -> bool:
        return not self.by_words or ODD.search(text) is not None or (self.added is not None and self.added.search(text) is not None)

    def __call__(self, texts, at_once: int = 64):
        """Yield the ids of each text in turn (null: empty); equal texts of a batch are encoded once."""
        texts = [t if isinstance(t, str) else "" for t in texts]
        for i in range(0, len(texts), at_once):
            part = texts[i : i + at_once]
            if len(self.words) > self.most // 2:
                self.words.older = {}
                self.words = Words(self.words)
            known, ids = self.words, {}
            direct = [t for t in dict.fromkeys(part) if self.whole(t)]
            ids.update(zip(direct, self.library(direct)))
            split = {t: list(map(known.__getitem__, SPLIT.findall(t))) for t in dict.fromkeys(part) if t not in ids}
            new, known.new = known.new, []
            for w, b in zip(new, self.library(new)):
                known[w][:] = b
            for t, pieces in split.items():
                ids[t] = b"".join(pieces)
            known.update(zip(new, [bytes(known[w]) for w in new]))
            yield from map(ids.__getitem__, part)


@functools.lru_cache(maxsize=1)
def load(path: str) -> Encoder:
    return Encoder(path)
