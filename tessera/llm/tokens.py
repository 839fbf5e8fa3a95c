"""Whole-text token ids by a public `tokenizers` file, with per-worker caches.

The word tokenizer drops white space and never merges across it, so the ids of a text are the ids of
its blank-separated chunks in order (Unicode composition and lower-casing do not reach across a blank
either). Chunks of plain Latin-1 characters are cut into letter runs, digits and other runs as the file's
own pattern does, and each part goes to the file's merge model; all other chunks go through the library
whole. A file for which a probe shows any difference is used on whole texts.

Each worker keeps the ids of the first ``cache`` chunks and parts it meets; the rest is encoded again,
so memory is bounded and results never depend on the caches.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from tessera.llm.common import worker_cache

CACHE = 800_000
PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
PART = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
PROBE = ["The Straße,", "naïve;Café", "x1y22.&&&", "éa", "a|b--C", "ÀÖÿ!", "don", "AKIA12QZ==", "###"]


def vocabulary() -> str:
    """The default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """Letters of byte-level models for the characters whose UTF-8 bytes they replace: printable Latin-1
    stands for itself as a byte, all other bytes take the code points from 256 on, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    letter = {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Chunks(dict):
    """Ids by chunk; a chunk that is not there is encoded when it is asked for."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        return self.encode(chunk)


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, cache: int = CACHE):
        self.limit = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = byte_letters()
        self.cache = Chunks(self.chunk)
        self.parts: dict[str, bytes] = {}
        probe = self.whole(PROBE)
        self.by_part = True
        self.by_part = [self.chunk(c) for c in PROBE] == probe
        self.cache = Chunks(self.chunk)
        self.by_chunk = self.whole([" ".join(PROBE) + "\n" + " \n".join(PROBE)]) == [b"".join(probe * 2)]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            letters = part if part.isascii() else part.translate(self.letters)
            got = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
            if len(self.parts) < self.limit:
                self.parts[part] = got
        return got

    def chunk(self, chunk: str) -> bytes:
        """The ids of one chunk without blanks."""
        if self.by_part and PLAIN.fullmatch(chunk) and "<|" not in chunk:
            got = b"".join([self._part(p) for p in PART.findall(chunk.lower())])
        else:
            got = self.whole([chunk])[0]
        if len(self.cache) < self.limit:
            self.cache[chunk] = got
        return got

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text; null and empty texts have none."""
        if not self.by_chunk:
            return self.whole([t or "" for t in texts])
        ids = self.cache.__getitem__
        return [b"".join(map(ids, text.replace("\n", " ").split(" "))) if text else b"" for text in texts]


def encoder(path: str, cache: int = CACHE) -> ChunkEncoder:
    return worker_cache(f"chunks:{cache}:{path}", lambda: ChunkEncoder(path, cache))
