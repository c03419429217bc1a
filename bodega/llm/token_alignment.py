"""Cross-tokenizer alignment by interval coalescing, and how often aligned ids meet in the corpus.

Both tokenizers cut the same bytes. The tokens of A and B are sorted together by their first byte; the running maximum of
their ends tells where a group ends: at a start that reaches it, no token of either goes across. Within a group every A
token is linked with every B token. An id pair counts once for each document that holds it linked.

Neither tokenizer merges across the place where white space follows something else, or an ASCII mark a Latin letter, so texts are
cut there into units, and each distinct unit is tokenized and aligned once per worker, many new ones in one call, as one text; of a
full table the units used most stay. Texts in which that does not hold are one unit. Documents go on
in chunks of some million characters: a chunk's distinct pairs are counted over the corpus and the counts brought back to the chunk,
so that a frequent pair travels once a chunk, not once a document.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bodega.llm import common
from bodega.llm.tokens import LETTERS, Encoder

#: Characters of a chunk's texts; a longer text is a chunk of its own.
CHUNK = 2_000_000
#: Units, and characters of units, that a worker keeps. Beyond so many units the half used most stays, beyond so many characters none.
KEPT_UNITS, KEPT_CHARACTERS = 250_000, 32_000_000
#: So many new units are tokenized and aligned at once.
NEW_UNITS = 20_000
#: Stands before new units that are tokenized as one text, and before each of them that starts with a mark.
AHEAD = " x"

UNITS = re.compile(r"\s*\S+|\s+")
MARKS = r"!-/:-@\[-`{-~"
#: Units that also end where a mark follows a letter; the last match is empty.
SHORT_UNITS = re.compile(rf"\s*+[^\s{LETTERS}]*+(?:[{LETTERS}]++(?:[^\s{LETTERS}{MARKS}][^\s{LETTERS}]*+)?+)*+")
#: A text with one of these is one unit: white space to one side only, or part of what the piece model joins to a word.
WHOLE = re.compile("[\r\x1c-\x1f▁\x00]")
#: A piece that would join a unit's end to the white space after it.
JOINS = re.compile("[^\\s▁]▁|\\S[^\\S\r]")
#: A piece that would join a letter to the mark after it.
JOINS_MARKS = re.compile(f"[{LETTERS}][{MARKS}]")
SPACE = "▁"

TOTALS = ["n_a", "n_b", "n_groups", "n_links"]
CHUNKS = ", ".join(["doc_ids array<long>", *[f"{c} array<long>" for c in TOTALS], "sums array<string>", "sizes array<int>",
                    "places binary", "times binary", "pairs array<struct<a: int, b: int, n: long>>"])
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PlainEncoder(Encoder):
    """Byte-level encoder to which special tokens' strings are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        codes = {c: b for b, c in self.characters.items()}
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = {i: bytes(codes[c] for c in t) if all(c in codes for c in t) else t.encode() for t, i in names.items()}


class Pieces:
    """The piece model, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes_of = {i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)}
        self.space = self.model.piece_to_id(SPACE)
        self.cuts = not any(JOINS.search(p) for p in names)
        # Control pieces and the unknown one never stand for characters of a text.
        self.cuts_marks = not any(
            JOINS_MARKS.search(p) for i, p in enumerate(names) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)))

    def whole(self, text: str) -> list[int]:
        """Of a text with a space before it, which the model puts there itself; other white space in front gets one more."""
        if text == " ":
            return [self.space]
        return self.model.encode(text[1:]) if text[0] == " " else self.model.encode(text)[1:]


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The group of each interval: groups break where a start reaches the running maximum of the ends."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group


class Aligner:
    """Units by number, with their totals, their groups as text and their id pairs."""

    def __init__(self, byte_tokenizer: str, piece_model: str):
        self.a, self.b = PlainEncoder(byte_tokenizer), Pieces(piece_model)
        self.bytes_a, self.bytes_b = ([t.get(i, b"") for i in range(max(t) + 1)] for t in (self.a.bytes_of, self.b.bytes_of))
        self.size_a, self.size_b = (np.array(list(map(len, t))) for t in (self.bytes_a, self.bytes_b))
        # An id's text with each mark that may follow it: between ids, between A and B, between groups, between units.
        self.marked = {mark: np.array([f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b)))], object) for mark in ",|;\n"}
        self.cuts = self.b.cuts and self.a.kind == "byte"
        self.clear()

    def clear(self) -> None:
        self.number: dict[str | tuple[str], int] = {}
        self.characters = 0
        self.text: list[str] = []
        self.good: np.ndarray = np.zeros(0, bool)
        self.totals = np.zeros((0, 4), np.int64)
        self.used = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units(self, text: str) -> list[str | tuple[str]]:
        """A text with a space before it, cut; a tuple is a text that is not cut."""
        if not self.cuts or WHOLE.search(text):
            return [(" " + text,)]
        return SHORT_UNITS.findall(" " + text)[:-1] if self.b.cuts_marks else UNITS.findall(" " + text)

    def keep_most_used(self, n: int) -> None:
        """Keep the n units with the most uses, older uses counting half; their numbers change."""
        if n >= len(self.used):
            return
        at = np.sort(np.argpartition(self.used, len(self.used) - n)[len(self.used) - n:])
        keys = list(self.number)
        self.number = {keys[i]: k for k, i in enumerate(at.tolist())}
        self.characters = sum(len(k) if isinstance(k, str) else len(k[0]) for k in self.number)
        self.text = [self.text[i] for i in at.tolist()]
        places, sizes = self._places(at)
        self.pairs, self.times = self.pairs[places], self.times[places]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.good, self.totals, self.used = self.good[at], self.totals[at], self.used[at] // 2

    def learn(self, units: set) -> None:
        """Number the units that are new."""
        new = units.difference(self.number)
        if self.characters > KEPT_CHARACTERS:
            self.clear()
            new = units
        elif len(self.number) + len(new) > KEPT_UNITS:
            self.keep_most_used(KEPT_UNITS // 2)
            new = units.difference(self.number)
        new = list(new)
        for at in range(0, len(new), NEW_UNITS):
            some = new[at:at + NEW_UNITS]
            # Units that end in white space, and texts that are not cut, are tokenized alone.
            plain = [u for u in some if isinstance(u, str) and not u[-1].isspace()]
            alone = [u for u in some if not isinstance(u, str) or u[-1].isspace()]
            # Those that start with a mark come last.
            plain = [u for u in plain if u[0].isspace()] + [u for u in plain if not u[0].isspace()]
            joined = self._together(plain) if plain else None
            if joined is not None:
                self._add(plain, *joined)
            elif plain:
                self._add(plain, *self._alone(plain))
            if alone:
                self._add(alone, *self._alone([u if isinstance(u, str) else u[0] for u in alone]))

    def _together(self, units: list[str]) -> tuple[np.ndarray, ...] | None:
        """(good, unit and id of A's tokens, unit and id of B's) of units read as one text; none if a token is not within a unit."""
        spaced = sum(u[0].isspace() for u in units)
        parts = [AHEAD, *units[:spaced], *[p for u in units[spaced:] for p in (AHEAD, u)]]
        # Which unit a part is; -1: what stands before one.
        owner = np.full(len(parts), -1)
        owner[1:spaced + 1] = np.arange(spaced)
        owner[spaced + 2::2] = np.arange(spaced, len(units))
        text = "".join(parts)
        ends, raw, out = np.cumsum([len(p.encode()) for p in parts]), text.encode(), []
        for ids, table, size in ((self.a.tokenizer.encode(text, add_special_tokens=False).ids, self.bytes_a, self.size_a),
                                 (self.b.whole(text), self.bytes_b, self.size_b)):
            if b"".join(map(table.__getitem__, ids)) != raw:
                return None
            ids = np.array(ids, np.int64)
            stop = np.cumsum(size[ids])
            part = np.searchsorted(ends, stop - size[ids], "right")
            if (stop > ends[part]).any():
                return None
            unit = owner[part]
            own = unit >= 0
            out += [unit[own], ids[own]]
        return np.ones(len(units), bool), *out

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        good, out = np.zeros(len(texts), bool), [[], [], [], []]
        for i, t in enumerate(texts):
            ahead = "" if t[0].isspace() else AHEAD
            raw = t.encode()
            own = [self.a.tokenizer.encode(ahead + t, add_special_tokens=False).ids, self.b.whole(ahead + t)]
            tables = self.bytes_a, self.bytes_b
            if ahead:
                own = [after(ids, table, len(AHEAD)) for ids, table in zip(own, tables, strict=True)]
            good[i] = all(b"".join(map(table.__getitem__, ids)) == raw for ids, table in zip(own, tables, strict=True))
            if good[i]:
                for k, ids in enumerate(own):
                    out[2 * k] += [i] * len(ids)
                    out[2 * k + 1] += ids
        return good, *[np.array(x, np.int64) for x in out]

    def _add(self, keys: list, good: np.ndarray, unit_a: np.ndarray, a: np.ndarray, unit_b: np.ndarray, b: np.ndarray) -> None:
        # Good units lie one after the other, so a unit's first byte starts a group.
        n = len(keys)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.concatenate([ends_a, ends_b])
        group = coalesce(np.concatenate([ends_a - self.size_a[a], ends_b - self.size_b[b]]), ends)
        group_a, group_b = group[:len(a)], group[len(a):]
        groups = int(group.max()) + 1 if len(group) else 0
        per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        unit = np.zeros(groups, np.int64)
        unit[group_a] = unit_a

        self.text += self._texts(n, unit, unit_a, a, group_a, b, group_b)
        n_links = np.zeros(n, np.int64)
        np.add.at(n_links, unit, per_a * per_b)
        counts = [np.bincount(x, minlength=n) for x in (unit_a, unit_b, unit)]
        self.totals = np.concatenate([self.totals, np.stack([*counts, n_links], axis=1)])
        self.good = np.concatenate([self.good, good])
        self.used = np.concatenate([self.used, np.zeros(n, np.int64)])

        # Distinct ids of a group with their numbers, then every A id with every B id.
        (ga, ia, ta), (gb, ib, tb) = distinct(group_a, a), distinct(group_b, b)
        begin = np.searchsorted(gb, np.arange(groups + 1))
        width = np.diff(begin)[ga]
        left = np.repeat(np.arange(len(ga)), width)
        right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + begin[ga][left]
        owner, pair, times = distinct(unit[ga][left], ia[left] << 32 | ib[right], ta[left] * tb[right])
        self.pairs, self.times = np.concatenate([self.pairs, pair]), np.concatenate([self.times, times])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.bincount(owner, minlength=n))])
        self.number.update(zip(keys, range(len(self.number), len(self.number) + n), strict=True))
        self.characters += sum(len(k) if isinstance(k, str) else len(k[0]) for k in keys)

    def _texts(self, n: int, unit: np.ndarray, unit_a: np.ndarray, a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray) -> list[str]:
        """Per unit its groups: ids joined by commas, A and B by a bar, groups by semicolons."""
        if not len(a):
            return [""] * n
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        of = unit[group_b]
        ends = np.append(of[1:] != of[:-1], True)
        shown = np.concatenate([
            np.where(last_a, self.marked["|"][a], self.marked[","][a]),
            np.where(ends, self.marked["\n"][b], np.where(last_b, self.marked[";"][b], self.marked[","][b]))])
        order = np.lexsort((np.arange(len(shown)) >= len(a), np.concatenate([group_a, group_b])))
        texts = "".join(shown[order].tolist()).split("\n")
        out = [""] * n
        for u, text in zip(np.unique(of).tolist(), texts, strict=False):
            out[u] = text
        return out

    def _places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the units' pairs stand, unit after unit, and how many each has."""
        sizes = self.first[numbers + 1] - self.first[numbers]
        return np.repeat(self.first[numbers] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()), sizes

    def document(self, units: list) -> tuple[np.ndarray, str, np.ndarray, np.ndarray] | None:
        """(totals, groups as text, distinct pairs, their links) of a text's learned units; none if bytes differ."""
        at = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        if not self.good[at].all():
            return None
        own, times = np.unique(at, return_counts=True)
        self.used[own] += times
        places, sizes = self._places(own)
        pairs, which = np.unique(self.pairs[places], return_inverse=True)
        links = np.bincount(which, self.times[places] * np.repeat(times, sizes), len(pairs)).astype(np.int64)
        return self.totals[at].sum(axis=0), ";".join([self.text[i] for i in at.tolist()]), pairs, links


def after(ids: list[int], table: list[bytes], size: int) -> list[int]:
    """The ids behind the first `size` bytes."""
    at = 0
    while size > 0 and at < len(ids):
        size -= len(table[ids[at]])
        at += 1
    return ids[at:]


def distinct(group: np.ndarray, key: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, key), sorted, with their number or weight."""
    if weight is None:
        weight = np.ones(len(key), np.int64)
    if not len(key):
        return group, key, weight
    order = np.lexsort((key, group))
    group, key, weight = group[order], key[order], weight[order]
    fresh = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])]))
    return group[fresh], key[fresh], np.add.reduceat(weight, fresh)


@functools.lru_cache(maxsize=1)
def aligner(byte_tokenizer: str, piece_model: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(byte_tokenizer, piece_model)


def chunks_of(batches: Iterator, chunk: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of batches (doc_id, text) in chunks of about `chunk` characters."""
    ids, texts, total = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            if texts and total + len(text) > chunk:
                yield ids, texts
                ids, texts, total = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            total += len(text)
        # A batch's texts are not held beyond it.
        if texts:
            yield ids, texts
            ids, texts, total = [], [], 0


def documents_of(tool: Aligner, texts: list[str]) -> Iterator[tuple[np.ndarray, str, np.ndarray, np.ndarray] | None]:
    cut = [tool.units(t) if t else [] for t in texts]
    tool.learn(set().union(*cut))
    for units in cut:
        yield tool.document(units) if units else None


def aligned_chunks(docs: DataFrame, byte_tokenizer: str, piece_model: str, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk: its documents' ids, totals, digests and pairs as places in the chunk's distinct pairs."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_tokenizer, piece_model)
        none = np.zeros(0, np.int64)
        for ids, texts in chunks_of(batches, chunk):
            found = [d or (np.zeros(4, np.int64), None, none, none) for d in documents_of(tool, texts)]
            sums = ["" if d[1] is None else hashlib.sha256(d[1].encode()).hexdigest() for d in found]
            pairs, places, docs_with = np.unique(np.concatenate([d[2] for d in found]), return_inverse=True, return_counts=True)
            totals = np.stack([d[0] for d in found])
            links = np.concatenate([d[3] for d in found])
            rows = pa.StructArray.from_arrays(
                [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(docs_with.astype(np.int64))],
                ["a", "b", "n"])
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.record_batch(
                [one(pa.array(ids, pa.int64())), *[one(pa.array(totals[:, i])) for i in range(4)], one(pa.array(sums, pa.string())),
                 one(pa.array([len(d[2]) for d in found], pa.int32())), pa.array([places.astype("<i4").tobytes()]),
                 pa.array([links.astype("<i8").tobytes()]), one(rows)],
                names=["doc_ids", *TOTALS, "sums", "sizes", "places", "times", "pairs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, documents, best): in how many documents of the settled chunks a pair is linked, and if that is its A id's highest."""
    counts = common.settle(
        chunks.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.sum("p.n").alias("documents")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def align(docs: DataFrame, byte_tokenizer: str, piece_model: str, chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, tokens of A and B, groups, links, n_best and count_sum over the links, digest of the groups.

    A reads a space and the text, B the text (it adds the space). A text that is null or empty, or whose tokens' bytes do not join to
    what was read, has no tokens: zeros and an empty digest. Null and repeated doc_ids are ordinary rows, each a document
    of its own in the counts. Other columns are not read; an empty table gives an empty one.
    """
    import pyarrow as pa

    chunks = common.settle(aligned_chunks(docs, byte_tokenizer, piece_model, chunk).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    counts = common.settle(pair_counts(chunks), "pairs")
    # At most the distinct pairs of one chunk meet in a group.
    own = (
        chunks.select("chunk", F.posexplode("pairs").alias("at", "p")).select("chunk", "at", "p.a", "p.b").join(counts, ["a", "b"])
        .groupBy("chunk").agg(F.collect_list(F.struct("at", "documents", "best")).alias("counts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            for row in range(batch.num_rows):
                sizes = column("sizes")[row].values.to_numpy().astype(np.int64)
                places = np.frombuffer(column("places")[row].as_py(), "<i4")
                links = np.frombuffer(column("times")[row].as_py(), "<i8")
                documents, best = np.zeros((2, int(places.max()) + 1 if len(places) else 0), np.int64)
                if len(places):
                    counts = column("counts")[row].values
                    at = counts.field("at").to_numpy()
                    documents[at] = counts.field("documents").to_numpy()
                    best[at] = counts.field("best").to_numpy(zero_copy_only=False)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[edges])
                yield pa.record_batch(
                    [column("doc_ids")[row].values, *[column(c)[row].values for c in TOTALS], pa.array(total(links * best[places])),
                     pa.array(total(links * documents[places])), column("sums")[row].values],
                    names=["doc_id", *TOTALS, "n_best", "count_sum", "groups_sha256"])

    rows = chunks.drop("pairs").join(own, "chunk", "left").drop("chunk")
    return rows.mapInArrow(run, RESULT)


def groups(docs: DataFrame, byte_tokenizer: str, piece_model: str, chunk: int = CHUNK) -> DataFrame:
    """Per row doc_id and its groups in order, each an array of A ids and one of B ids; none without tokens."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_tokenizer, piece_model)
        numbers = pa.list_(pa.int32())
        kind = pa.list_(pa.struct([("a", numbers), ("b", numbers)]))
        for ids, texts in chunks_of(batches, chunk):
            out = []
            for found in documents_of(tool, texts):
                both = [g.split("|") for g in found[1].split(";")] if found else []
                out.append([{"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in both])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, kind)], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")
