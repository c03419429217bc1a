"""Token ids of whole texts, as packed little-endian unsigned 32-bit numbers.

Tokenizing costs most per distinct word, not per word. White space always separates what a tokenizer of the two
kinds below merges, so a text is cut there into units, and each distinct unit is encoded once per worker, or once for
many texts that are encoded together. Units of
plain Latin characters are cut by the tokenizer's own pattern and given to its model; all others, and texts with a
special token's string in them, go through the tokenizer whole. The ids equal
``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import functools
import json
import os
import re
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    import pyarrow as pa

#: Entries of a worker's unit cache; it starts afresh beyond that.
CACHE = 400_000
#: Longer units are encoded without being kept.
LONG_UNIT = 64

LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
#: Letters whose lower case or normal form depends on more than the letter are left out (capital I with dot).
SIMPLE = re.compile("[\t\n\r\x20-\x7eÀ-įı-ſ]*")
#: White space by the Unicode property, which the tokenizers' patterns use.
WHITE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space for str.split() only.
ODD = re.compile("[\x1c-\x1f]")
UNITS = re.compile(f"[{WHITE}]+(?![^{WHITE}])| ?[^{WHITE}]+|[{WHITE}]+")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PIECES = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
BYTE_PIECES = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s{LETTERS}0-9]+|\\s+(?!\\S)|\\s+")

#: What most units are: letters, then marks that cannot start a contraction. Both are pieces.
WORD_AND_MARKS = re.compile(rf"( ?[{LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")


def byte_characters() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """`kind`: "word" (white space dropped, lower case), "byte" (white space kept) or "other" (no units)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.kind = kind_of(layout)
        self.special = [t["content"] for t in layout.get("added_tokens", [])]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.characters = byte_characters()
        self.units: dict[str, bytes | None] = {}
        self.loose: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        packed = self.packed
        return b"".join([packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            letters = piece.encode().decode("latin-1").translate(self.characters)
            out = b"".join([self.packed[t.id] for t in self.model.tokenize(letters)])
            if len(piece) <= LONG_UNIT:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = out
        return out

    def unit(self, unit: str) -> bytes:
        if self.kind == "byte" and (found := WORD_AND_MARKS.fullmatch(unit)):
            word, marks = found.groups()
            ids = self.pieces.get(word) or self.piece(word)
            return ids + (self.pieces.get(marks) or self.piece(marks)) if marks else ids
        if not SIMPLE.fullmatch(unit):
            return self.whole(unit)
        if self.kind == "word":
            return b"".join([self.piece(p) for p in WORD_PIECES.findall(unit.lower())])
        return b"".join([self.piece(p) for p in BYTE_PIECES.findall(unit)])

    def joined(self, units: list[str], cache: dict) -> bytes:
        missing = set(units).difference(cache)
        if len(cache) + len(missing) > CACHE:
            cache.clear()
            missing = set(units)
        long = {}
        for u in missing:
            # A unit that ends in white space may belong together with the next one.
            is_open = cache is self.units and self.kind == "byte" and (u == "" or u[-1].isspace())
            (cache if len(u) <= LONG_UNIT else long)[u] = None if is_open else self.unit(u)
        if long:
            return b"".join([long[u] if u in long else cache[u] for u in units])
        return b"".join(map(cache.__getitem__, units))

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a text; null and empty texts have none."""
        if not text:
            return b""
        if self.kind == "other" or any(s in text for s in self.special):
            return self.whole(text)
        if self.kind == "word":
            return self.whole(text) if ODD.search(text) else self.joined(text.split(), self.units)
        units = text.replace(" ", "\0 ").split("\0") if "\0" not in text else UNITS.findall(text)
        try:
            return self.joined(units if units[0] else units[1:], self.units)
        except TypeError:  # a unit whose end is open
            return self.joined(UNITS.findall(text), self.loose)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """`encode` of each text, where each distinct unit of all texts is encoded once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.kind != "byte":
            return [self.encode(t) for t in texts.to_pylist()]
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        cut = pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")
        coded = cut.flatten().dictionary_encode()
        which, edges = coded.indices.to_numpy(), cut.offsets.to_numpy()
        edges = edges - edges[0]
        units = coded.dictionary.to_pylist()
        ids = list(map(self.unit, units))
        ends_open = np.array([u != "" and u[-1].isspace() for u in units], bool)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        n = sizes[which]
        stop = np.cumsum(n)
        places = np.repeat(first[which] - stop + n, n) + np.arange(n.sum())
        packed = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        # Texts in which a unit's end is open, or that units cannot be told in, go one by one.
        alone = np.diff(np.concatenate([[0], np.cumsum(ends_open[which])])[edges]) > 0
        for s in ["\0", *self.special]:
            alone |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        at = 4 * np.concatenate([[0], stop])[edges]
        return [self.encode(texts[i].as_py()) if one else packed[a:b]
                for i, (one, a, b) in enumerate(zip(alone.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True))]


def kind_of(layout: dict) -> str:
    """Which of the two known ways of cutting a text into pieces the tokenizer's file states."""
    model, cut, norm = layout.get("model") or {}, layout.get("pre_tokenizer") or {}, layout.get("normalizer")
    if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
        return "other"
    if norm is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True):
        return "byte"
    steps = [s.get("type") for s in cut.get("pretokenizers", [])]
    pattern = next((s["pattern"].get("Regex") for s in cut.get("pretokenizers", []) if s.get("type") == "Split"), "")
    known = CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    norms = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if steps == ["Split", "ByteLevel"] and pattern == known and norms == ["NFC", "Replace", "Lowercase"]:
        return "word"
    return "other"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    return Encoder(path)
