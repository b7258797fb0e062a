"""What byte-level BPE tokenizers of the public `tokenizers` JSON format share: alphabet, vocabulary, merges and pre-token pattern."""

from __future__ import annotations

import json
from functools import lru_cache
from pathlib import Path

import numpy as np

#: White_Space of Unicode, which the pattern's \s stands for.
SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Fixed value: the pre-token pattern, with \s written out.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(1)
def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class MergeTable:
    """Merges for whole arrays: rank(left ids, right ids), -1 where there is none; parts[rank] is (left, right, merged)."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        rows = sorted((a << 32 | b, rank) for (a, b), (rank, _) in merges.items())
        self.keys = np.array([k for k, _ in rows], np.int64)
        self.ranks = np.array([r for _, r in rows], np.int64)
        self.parts = {rank: (a, b, made) for (a, b), (rank, made) in merges.items()}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class Vocabulary:
    """ids of byte strings, the byte string of each id, merges as {(id, id): (rank, id)}, added tokens as {text: id}."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        model = spec["model"]
        kinds = (model["type"], (spec.get("pre_tokenizer") or {}).get("type"), spec.get("normalizer"))
        if kinds != ("BPE", "ByteLevel", None) or spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError(f"not a byte-level BPE file: {path}")
        back = {c: b for b, c in enumerate(byte_letters())}
        plain = {t: i for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*plain.values(), *self.added.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for text, i in plain.items():
            if text not in self.added:
                self.bytes_of[i] = bytes(back[c] for c in text)
        for text, i in self.added.items():
            self.bytes_of[i] = text.encode()
        self.byte_id = [plain[c] for c in byte_letters()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[plain[a], plain[b]] = (rank, plain[a + b])
        self.names = [str(i) for i in range(size)]
        self.plain_ids = [i for t, i in plain.items() if t not in self.added]

    def merge_table(self) -> MergeTable:
        if not hasattr(self, "_table"):
            self._table = MergeTable(self.merges)
        return self._table

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-token, by the plain definition: merge the pair of lowest rank, leftmost first."""
        ids = [self.byte_id[b] for b in word]
        while len(ids) > 1:
            rank, k = min((self.merges[p][0] if (p := (ids[k], ids[k + 1])) in self.merges else 1 << 60, k) for k in range(len(ids) - 1))
            if rank == 1 << 60:
                break
            ids[k : k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def pieces(text: str, added: dict[str, int]):
    """The text cut at added tokens: (piece, False) or (added token, True). The earliest match wins, then the longest."""
    if not any(a in text for a in added):
        yield text, False
        return
    import re

    cut = re.compile("|".join(re.escape(a) for a in sorted(added, key=len, reverse=True)))
    at = 0
    for m in cut.finditer(text):
        yield text[at : m.start()], False
        yield m.group(), True
        at = m.end()
    yield text[at:], False
