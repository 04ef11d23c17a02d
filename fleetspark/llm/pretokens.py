"""Byte-level BPE through its pre-tokens, with caches of one Python worker.

A byte-level BPE never merges across pre-tokens, so a text's ids are those of
its pre-tokens in a row. Each distinct pre-token is encoded once per worker
(in batches, by the tokenizers library) and looked up afterwards."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata

from tokenizers import Tokenizer

#: Characters whose classes no Unicode version has changed (Latin letters and
#: common punctuation); a text with any other goes to the library whole.
USUAL = [*map(chr, (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028)))]
UNUSUAL = re.compile(f"[^{re.escape(''.join(USUAL))}]")
LETTER, NUMBER = (re.escape("".join(c for c in USUAL if unicodedata.category(c)[0] == k)) for k in "LN")
#: Fixed value: the published pre-token pattern of byte-level BPE vocabularies,
#: its classes spelled out for usual characters.
PRE_TOKEN = (rf" ?[{LETTER}]+|'(?:[sdmt]|ll|ve|re)| ?[{NUMBER}]+| ?[^ \t\n\r{LETTER}{NUMBER}]+"
             r"|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+")
CACHE = 1_000_000
ENCODED = 10_000  # texts that the library encodes at once
THREADS = 2  # of one worker (its share of an executor's cores)


class PreTokens:
    """The pre-tokens of a text and the ids of pre-tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.splits = (spec["model"]["type"] == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                       and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pattern = re.compile(PRE_TOKEN)

    def of(self, text: str) -> list[str] | None:
        """Pre-tokens, or None where the library has to see the whole text:
        unusual characters, or the strings of added tokens."""
        if not self.splits or UNUSUAL.search(text) or any(t in text for t in self.special):
            return None
        return self.pattern.findall(text)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), ENCODED)
                for e in self.tokenizer.encode_batch_fast(texts[i:i + ENCODED], add_special_tokens=False)]

    @property
    def wide(self) -> bool:
        return self.tokenizer.get_vocab_size() > 1 << 16


@functools.cache
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


def fill(known: dict, floor: dict, asked: set, encode) -> None:
    """Adds what ``encode`` gives for the asked keys that are not known; a cache
    that has grown past CACHE starts again from ``floor``."""
    if len(known) > CACHE:
        known.clear()
        known.update(floor)
    missing = sorted(asked.difference(known))
    known.update(zip(missing, encode(missing), strict=True))
