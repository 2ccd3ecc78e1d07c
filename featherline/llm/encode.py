"""Fast byte-level BPE: the ids that the tokenizers library gives for a vocabulary file and its added tokens, each different word of a block encoded once."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-tokenisation pattern of the byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A space that doesn't begin a piece, as white space (or what Python takes for it) or the end comes next.
_LOOSE = r" (?:[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"


class Encoder:
    """Encodes the texts of a column by their different words, a block of rows at a time; nothing is kept from block to block.

    A space before a character that isn't white space begins a piece under PATTERN whatever stands around it, so a text
    may be cut there and each part encoded alone, or in a row with others. Texts with other spaces are encoded whole.
    """

    def __init__(self, path: str, block: int = 1 << 21):
        import tiktoken

        self.block = block
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.added = {t["content"]: np.array([t["id"]], "<u4") for t in file.get("added_tokens") or []}
        if odd := [t["content"] for t in file.get("added_tokens") or [] if t["single_word"] or t["lstrip"] or t["rstrip"]]:
            raise ValueError(f"added tokens that depend on what stands around them: {odd}")
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        byte = {c: b for b, c in enumerate(_byte_chars())}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(model["merges"])}
        self.bpe = tiktoken.Encoding("featherline", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.strings: list[bytes] = [b""] * (1 + max(ranks.values()))
        for k, v in ranks.items():
            self.strings[v] = k
        self.sizes = np.array([len(x) for x in self.strings])

    def whole(self, text: str) -> np.ndarray:
        """The ids of a text without added tokens, or of a part that may stand alone."""
        return np.array(array("I", self.bpe.encode_ordinary(text)), "<u4")

    def ids(self, text: str | None) -> np.ndarray:
        """Added tokens are one id wherever they stand, as in the library; what is between them is encoded alone."""
        if not text:
            return np.empty(0, "<u4")
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self.whole(text[at : m.start()]), self.added[m[0]]]
            at = m.end()
        return np.concatenate([*out, self.whole(text[at:])])

    def blocks(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For successive rows of about `block` bytes of text: the ids of all, in order, and how many each row has (none if null)."""
        texts = pc.fill_null(texts, "")
        at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // self.block
        for rows in np.split(np.arange(len(at)), 1 + np.flatnonzero(np.diff(at))):
            if len(rows):
                yield self._block(texts.slice(int(rows[0]), len(rows)))

    def rows(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each row."""
        for ids, n in self.blocks(texts):
            yield from np.split(ids, np.cumsum(n)[:-1])

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        alone = pc.match_substring_regex(texts, _LOOSE)
        for token in self.added:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        parts = pc.split_pattern(pc.if_else(alone, "", texts), " ")
        n = parts.value_lengths().to_numpy().astype(np.int64)
        parts = parts.flatten()
        # The first part of a row has no space before it; it, or the whole of a text that isn't cut, is encoded for itself.
        begin = np.cumsum(n) - n
        later = np.ones(len(parts), bool)
        later[begin] = False
        heads = [self.whole(x) for x in parts.take(pa.array(begin)).to_pylist()]
        for i in np.flatnonzero(alone.to_numpy(zero_copy_only=False)).tolist():
            heads[i] = self.ids(texts[i].as_py())
        # The others are encoded once each, all in a row; the sizes of the ids' strings tell where each ends.
        rest = parts.filter(pa.array(later)).dictionary_encode()
        words = rest.dictionary.cast(pa.string())
        row = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        pool = self.whole(" " + pc.binary_join(row, " ")[0].as_py() if len(words) else "")
        reached, ends = np.cumsum(self.sizes[pool]), np.cumsum(pc.binary_length(words).to_numpy().astype(np.int64) + 1)
        stop = np.searchsorted(reached, ends) + 1
        if not np.array_equal(reached[stop - 1], ends):
            raise ValueError("an id reaches over the space before a word")
        pool = np.concatenate([pool, *heads])
        size = np.concatenate([np.diff(stop, prepend=0), np.array([len(x) for x in heads], np.int64)])
        code = np.empty(len(parts), np.int64)
        code[later], code[begin] = rest.indices.to_numpy(), len(words) + np.arange(len(texts))
        each = size[code]
        take = np.repeat((np.cumsum(size) - size)[code] - (np.cumsum(each) - each), each)
        take += np.arange(len(take))
        return pool[take], np.add.reduceat(each, begin)


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself where printable, else the next code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process and vocabulary."""
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
