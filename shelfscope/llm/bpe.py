"""Byte-level BPE: distinct words are encoded by a fold in Spark, texts are spelled in them.

1. Texts are gathered into blocks of a bounded size. Each block lists its distinct
   words (matches of the vocabulary's pattern) and spells its texts as numbers of them.
2. The distinct words of all blocks meet in hash buckets. There every word that blocks
   share is encoded once: higher-order functions start from its bytes and merge, step by step, the
   adjacent pair of lowest rank, looked up in a rank map that is one broadcast row.
3. A block gets its words' ids back, in the order in which it listed them, and every
   text's ids follow.

So a word that the corpus uses a million times is merged once, and neither the
vocabulary in use nor a hot word is ever gathered in one place. Decoding joins the
byte pieces of the ids.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from .frames import with_own, without

#: UTF-8 bytes of text per block; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
#: A longer text is cut at a space after so many characters.
STREAM_CHARS = 4 << 20
#: Words of more bytes are merged by a heap where they are found: the fold's work grows with the square.
FOLD_BYTES = 64
#: No Latin-1 character, so it separates pieces written in Latin-1.
_SEPARATOR = "\u0100"
#: A space that is cut at.
_CUT = r"(?<=\S) (?=\S)"
#: For Arrow: texts in which some space may not be cut at; its class holds all white space, and may hold more.
_WHITE = r"[\x00-\x20\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]"
_ODD_SPACE = rf"^ | $|{_WHITE} | {_WHITE}"
#: For Arrow: parts that are letters, then ASCII marks, and so one or two matches of ``PLAIN_PATTERN``. It holds some of the letters.
_PLAIN_PART = (
    r"^(?P<letters> ?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{400}-\x{481}\x{3041}-\x{3096}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]+)"
    r"(?P<marks>[!-/:-@\[-`{-~]*)$"
)
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Word numbers packed into one row.
_RUN = 1 << 20
_NONE = 1 << 62
#: What ``encode_texts`` can give.
OUTPUTS = {"token_ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_text": pa.string(), "decoded": pa.binary()}


@dataclass(frozen=True)
class Vocabulary:
    """Byte pieces by rank, which is also their id, and the pattern that cuts a text into words."""

    pieces: tuple[bytes, ...]
    pattern: str

    @classmethod
    def from_ranks_file(cls, path: str, pattern: str) -> Vocabulary:
        """Read lines of a base64 piece and its rank; ranks run from 0 without gaps."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        pieces = tuple(sorted(ranks, key=ranks.__getitem__))
        if list(map(ranks.__getitem__, pieces)) != list(range(len(pieces))):
            raise ValueError("ranks have gaps")
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("a byte has no piece of its own")
        return cls(pieces, pattern)

    def ranks(self) -> dict[bytes, int]:
        return {piece: rank for rank, piece in enumerate(self.pieces)}


class RankMap:
    """Which piece two neighbouring pieces make, as one row of three arrays.

    A piece's row of a table, in which the next piece's id is the place, is laid into
    one array at a shift of its own, so that no two rows use one place: ``_bpe_shift`` has
    the shifts by id, ``_bpe_left`` says whose place it is, ``_bpe_rank`` what the pair makes.
    As a row, and not as a literal, the map is in no plan's text.
    """

    columns = ("_bpe_shift", "_bpe_left", "_bpe_rank")

    def __init__(self, vocabulary: Vocabulary) -> None:
        ranks = vocabulary.ranks()
        rows: dict[int, list[tuple[int, int]]] = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if a is not None and b is not None:
                    rows.setdefault(a, []).append((b, rank))
        # Long rows first, at random shifts; the arrays are so long that few are tried in vain.
        spread = 4 * sum(map(len, rows.values())) + 1
        rng = np.random.default_rng(0)
        self.shift = np.zeros(len(ranks), dtype=np.int32)
        self.left = np.full(spread + len(ranks), -1, dtype=np.int32)
        self.ranks = np.zeros(spread + len(ranks), dtype=np.int32)
        for a in sorted(rows, key=lambda a: -len(rows[a])):
            after, made = np.array(rows[a]).T
            while (self.left[after + (shift := int(rng.integers(spread)))] >= 0).any():
                pass
            self.shift[a], self.left[after + shift], self.ranks[after + shift] = shift, a, made

    def beside(self, df: DataFrame) -> DataFrame:
        """``df`` with the map in every row, for which ``encode`` looks; rows should be few."""
        texts = tuple(",".join(map(str, values.tolist())) for values in (self.shift, self.left, self.ranks))
        row = df.sparkSession.createDataFrame([texts], ", ".join(f"{c} string" for c in self.columns))
        return df.crossJoin(F.broadcast(row.select(*(F.split(c, ",").cast("array<int>").alias(c) for c in self.columns))))

    def rank(self, a: Column, b: Column) -> Column:
        """The id of the piece that two pieces make, else null."""
        shift, left, ranks = map(F.col, self.columns)
        at = F.get(shift, a) + b
        return F.when(F.get(left, at) == a, F.get(ranks, at))

    def encode(self, single: Column) -> Column:
        """Ids of a word, given those of its bytes: a fold that merges the leftmost pair of lowest rank.

        The fold's state is the parts' ids and the rank of each part with the next; the last has none.
        """

        def merge(before: Column, _: Column) -> Column:
            ids, pairs = before["ids"], before["pairs"]

            def joined(at: Column) -> Column:
                # The pair numbered ``at`` (from 1) becomes one part; its neighbours get new ranks.
                part = F.get(pairs, at - 1)
                left = F.when(at > 1, F.array(self.rank(F.get(ids, at - 2), part))).otherwise(none)
                right = F.array(self.rank(part, F.get(ids, at + 1)))
                return F.struct(
                    F.concat(F.slice(ids, F.lit(1), at - 1), F.array(part), F.slice(ids, at + 2, rest)).alias("ids"),
                    F.concat(F.slice(pairs, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(pairs, at + 2, rest)).alias("pairs"),
                )

            place = F.array_position(pairs, F.array_min(pairs)).cast("int")
            return F.coalesce(F.get(F.transform(F.filter(F.array(place), lambda at: at > 0), joined), F.lit(0)), before)

        none, rest = F.array().cast("array<int>"), F.size(single)
        pairs = F.transform(single, lambda a, i: self.rank(a, F.get(single, i + 1)))
        return F.aggregate(single, F.struct(single.alias("ids"), pairs.alias("pairs")), merge, lambda last: last["ids"])


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one word; a heap keeps the time for a long one near its length."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > FOLD_BYTES:
        return _merge_by_heap(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    found = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
    while found and (best := min(found)) != _NONE:
        at = found.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del found[at]
        if at:
            found[at - 1] = ranks.get(parts[at - 1] + parts[at], _NONE)
        if at < len(found):
            found[at] = ranks.get(parts[at] + parts[at + 1], _NONE)
    return [ranks[part] for part in parts]


def _merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    count = len(word)
    end = list(range(1, count + 1))
    before = list(range(-1, count - 1))

    def pair(start: int) -> tuple[int, int, int, int] | None:
        middle = end[start]
        if middle >= count:
            return None
        rank = ranks.get(word[start : end[middle]])
        return None if rank is None else (rank, start, middle, end[middle])

    heap = [p for p in map(pair, range(count)) if p]
    heapq.heapify(heap)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if end[start] != middle or end[middle] != stop:
            continue
        end[start], end[middle] = stop, -1
        if stop < count:
            before[stop] = start
        for at in (before[start], start):
            if at >= 0 and (found := pair(at)):
                heapq.heappush(heap, found)
    ids, at = [], 0
    while at < count:
        ids.append(ranks[word[at : end[at]]])
        at = end[at]
    return ids


def _pack(codes: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, compressed: small numbers leave the high planes empty."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(planes.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


_TEXT, _CODES, _WORDS, _KNOWN = range(4)
_OWN = pa.schema(
    [
        ("_bpe_block", pa.int64()),
        ("_bpe_kind", pa.int32()),
        ("_bpe_number", pa.int32()),
        ("_bpe_width", pa.int32()),
        ("_bpe_codes", pa.binary()),
        ("_bpe_words", pa.binary()),
    ]
)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...`` of runs, one run after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, starts.max(initial=0)) < 1 << 30 else np.int64
    places = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    places += np.arange(total, dtype=kind)
    return places


def _join(words: pa.BinaryArray) -> bytes:
    """Words of at most 255 bytes as their sizes, a byte each, and then their bytes."""
    joined = pa.array([b""], words.type) if not len(words) else pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b"")
    return np.asarray(pc.binary_length(words)).astype(np.uint8).tobytes() + joined[0].as_py()


def _part(count: int, data: bytes) -> pa.BinaryArray:
    """The words of ``_join``, ``count`` of them."""
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, dtype=np.uint8, count=count), dtype=np.int64)])
    return _cut(memoryview(data)[count:], ends, pa.binary())


def _cut(data, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Texts or bytes that lie one after the other."""
    offsets = pa.array(ends, pa.int32())
    return pa.Array.from_buffers(kind, len(ends) - 1, [None, offsets.buffers()[1], pa.py_buffer(data)])


def _split_odd(text: str, cut: regex.Pattern) -> Iterator[list[str]]:
    """Parts of a text in which not every space is cut at, some millions of characters at a time."""
    at = 0
    while at < len(text):
        stop = cut.search(text, at + STREAM_CHARS) if len(text) - at > STREAM_CHARS else None
        yield cut.split(text[at : stop.start()] if stop else text[at:])
        at = stop.end() if stop else len(text)


class _Block:
    """Texts of one block on their way to rows.

    A space between two other characters than white space always starts a word, so a
    text is first cut there, and only distinct parts are scanned for words.
    """

    def __init__(self, texts: list[pa.Array], carried: list[pa.RecordBatch], vocabulary: Vocabulary) -> None:
        self.scan, self.plain = regex.compile(vocabulary.pattern), vocabulary.pattern == PLAIN_PATTERN
        all_texts = pc.fill_null(pa.concat_arrays([t.cast(pa.string()) for t in texts]), "")
        odd = np.asarray(pc.match_substring_regex(all_texts, _ODD_SPACE))
        empty = np.asarray(pc.binary_length(all_texts)) == 0
        usual, others = np.flatnonzero(~odd & ~empty), np.flatnonzero(odd)
        self.carried = pa.Table.from_batches(carried).take(np.concatenate([usual, others, np.flatnonzero(empty)]))

        lists = pc.split_pattern(all_texts.take(pa.array(usual)), " ")
        counts, parts, cut = [np.asarray(pc.list_value_length(lists)).astype(np.int64)], [lists.flatten()], regex.compile(_CUT)
        for i in others:
            found = [pa.array(some, pa.string()) for some in _split_odd(all_texts[i].as_py(), cut)]
            parts.extend(found)
            counts.append(np.array([sum(map(len, found))], dtype=np.int64))
        #: Parts per text, in the order of ``carried``.
        self.counts = np.concatenate([*counts, np.zeros(int(empty.sum()), dtype=np.int64)])
        self._number(pa.concat_arrays(parts))

    def _number(self, parts: pa.StringArray) -> None:
        """Make ``parts`` the distinct ones and ``codes`` their numbers; all but a text's first have a space in front."""
        listed = parts.dictionary_encode()
        codes = np.asarray(listed.indices) * 2 + 1
        ends = np.cumsum(self.counts)
        codes[(ends - self.counts)[self.counts > 0]] -= 1
        used = np.zeros(2 * len(listed.dictionary), dtype=bool)
        used[codes] = True
        self.codes = (np.cumsum(used, dtype=np.int32) - 1)[codes]
        which = np.flatnonzero(used)
        lead = pa.array(["", " "]).take(pa.array(which % 2))
        self.parts = pc.binary_join_element_wise(lead, listed.dictionary.take(pa.array(which // 2)), "")

    def words(self) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Distinct words, often used ones first; all words of all texts as their numbers; how many each text has."""
        size = np.zeros(len(self.parts), dtype=np.int64)
        plain = pc.extract_regex(self.parts, _PLAIN_PART) if self.plain else pa.nulls(len(self.parts), pa.struct([("letters", pa.string()), ("marks", pa.string())]))
        simple = np.flatnonzero(np.asarray(plain.is_valid()))
        letters, marks = (plain.field(name).take(pa.array(simple)) for name in ("letters", "marks"))
        marked = np.flatnonzero(np.asarray(pc.binary_length(marks)) > 0)
        others = np.flatnonzero(np.asarray(plain.is_null()))
        found = list(map(self._scan, self.parts.take(pa.array(others)).to_pylist()))
        size[simple] = 1
        size[simple[marked]] = 2
        size[others] = list(map(len, found))
        start = np.cumsum(size) - size
        scanned = pa.array([word for words in found for word in words], pa.string())
        listed = pa.concat_arrays([letters.cast(pa.string()), marks.take(pa.array(marked)).cast(pa.string()), scanned]).dictionary_encode()
        numbers = np.asarray(listed.indices)
        flat = np.empty(len(numbers), dtype=np.int32)
        flat[start[simple]] = numbers[: len(simple)]
        flat[start[simple[marked]] + 1] = numbers[len(simple) : len(simple) + len(marked)]
        flat[_spread(start[others], size[others])] = numbers[len(simple) + len(marked) :]

        sizes = size[self.codes]
        codes = flat[_spread(start[self.codes], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(self.counts)])]
        del sizes
        order = np.argsort(-np.bincount(codes, minlength=len(listed.dictionary)), kind="stable")
        place = np.empty(len(order), dtype=np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        return listed.dictionary.take(pa.array(order)), place[codes], np.diff(ends)

    def _scan(self, part: str) -> list[str]:
        return self.scan.findall(part)

    def rows(self, block: int, buckets: int, ranks: dict[bytes, int], pieces: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        words, codes, lengths = self.words()
        count = len(lengths)
        yield from _rows(
            schema,
            count,
            _bpe_block=[block] * count,
            _bpe_kind=[_TEXT] * count,
            _bpe_number=range(count),
            _bpe_width=lengths,
            **{name: self.carried[name] for name in self.carried.column_names},
        )
        packed = [_pack(codes[i : i + _RUN]) for i in range(0, len(codes), _RUN)]
        rows = [(_CODES, i, None, data, None) for i, data in enumerate(packed)]
        data = words.cast(pa.binary())
        ids, width = pc.index_in(data, value_set=pieces), np.asarray(pc.binary_length(data))
        is_piece = np.asarray(ids.is_valid())
        if is_piece.any():
            rows.append((_KNOWN, None, 1, _pack(np.flatnonzero(is_piece)), _pack(np.asarray(ids.drop_null()))))
        for code in np.flatnonzero(~is_piece & (width > FOLD_BYTES)):
            own = merge_word(data[code].as_py(), ranks)
            rows.append((_KNOWN, None, len(own), _pack(np.array([code])), _pack(np.array(own))))
        listed = np.flatnonzero(~is_piece & (width <= FOLD_BYTES))
        bucket = np.fromiter(map(zlib.crc32, data.take(pa.array(listed)).to_pylist()), dtype=np.int64, count=len(listed)) % buckets
        listed = listed[np.argsort(bucket, kind="stable")]
        sizes = np.bincount(bucket, minlength=buckets)
        for number, end in enumerate(np.cumsum(sizes)):
            if size := int(sizes[number]):
                run = listed[end - size : end]
                rows.append((_WORDS, number, size, _pack(run), _join(data.take(pa.array(run)))))
        if rows:
            kind, number, width, code, data = zip(*rows, strict=True)
            yield from _rows(
                schema,
                len(rows),
                _bpe_block=[block] * len(rows),
                _bpe_kind=kind,
                _bpe_number=number,
                _bpe_width=width,
                _bpe_codes=code,
                _bpe_words=data,
            )


def _rows(schema: pa.Schema, count: int, **columns) -> Iterator[pa.RecordBatch]:
    """Batches of the schema; columns that aren't given are null."""

    def column(field: pa.Field):
        if field.name not in columns:
            return pa.nulls(count, field.type)
        given = columns[field.name]
        return given if isinstance(given, pa.ChunkedArray) else pa.array(given, field.type)

    yield from pa.table([column(field) for field in schema], schema=schema).to_batches(max_chunksize=5000)


def _spell(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text: str, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    ranks, pieces = vocabulary.ranks(), pa.array(vocabulary.pieces, pa.binary())
    number = TaskContext.get().partitionId() << 32
    texts, carried, total = [], [], 0
    for batch in batches:
        rest, begin = batch.drop_columns([text]), 0
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for i, size in enumerate(sizes):
            total += size
            if total >= BLOCK_BYTES or i + 1 == len(sizes):
                texts.append(batch.column(text).slice(begin, i + 1 - begin))
                carried.append(rest.slice(begin, i + 1 - begin))
                begin = i + 1
            if total >= BLOCK_BYTES:
                yield from _Block(texts, carried, vocabulary).rows(number, buckets, ranks, pieces, schema)
                number, texts, carried, total = number + 1, [], [], 0
                pa.default_memory_pool().release_unused()
    if texts:
        yield from _Block(texts, carried, vocabulary).rows(number, buckets, ranks, pieces, schema)


_LISTED = "_bpe_block long, _bpe_bucket int, _bpe_width int, _bpe_words binary"
_MEETING = pa.schema(
    [
        ("_bpe_bucket", pa.int32()),
        ("_bpe_single", pa.list_(pa.list_(pa.int32()))),
        ("_bpe_blocks", pa.list_(pa.int64())),
        ("_bpe_sizes", pa.list_(pa.int32())),
        ("_bpe_codes", pa.binary()),
    ]
)
_REPLY = pa.schema([("_bpe_block", pa.int64()), ("_bpe_bucket", pa.int32()), ("_bpe_width", pa.int32()), ("_bpe_ids", pa.binary())])


def _only_words(table: pa.Table) -> pa.Table:
    chosen = table.filter(pc.equal(table["_bpe_kind"], _WORDS))
    return chosen.select(["_bpe_block", "_bpe_number", "_bpe_width", "_bpe_words"]).rename_columns(
        ["_bpe_block", "_bpe_bucket", "_bpe_width", "_bpe_words"]
    )


def _meet(table: pa.Table, fold_from: int, single: np.ndarray) -> pa.Table:
    """The words of a bucket that enough blocks list, once each, as the ids of their bytes, and every block's list as their numbers from 1, else 0."""
    sizes = table["_bpe_width"].to_pylist()
    listed = pa.concat_arrays(list(map(_part, sizes, table["_bpe_words"].to_pylist()))).dictionary_encode()
    numbers = np.asarray(listed.indices)
    shared = np.bincount(numbers, minlength=len(listed.dictionary)) >= fold_from
    words = listed.dictionary.take(pa.array(np.flatnonzero(shared)))
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(words)), dtype=np.int64)])
    spelled = single[np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)]
    starts = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spelled, pa.int32()))
    codes = np.where(shared, np.cumsum(shared), 0)[numbers]
    row = {
        "_bpe_bucket": table["_bpe_bucket"][:1],
        "_bpe_single": pa.ListArray.from_arrays([0, len(starts)], starts),
        "_bpe_blocks": [table["_bpe_block"].to_pylist()],
        "_bpe_sizes": [sizes],
        "_bpe_codes": [_narrow(codes)],
    }
    return pa.table(row, schema=_MEETING)


def _reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To every block that listed words of a bucket: a byte for how many ids each has, 0 if it was not folded, and the ids."""
    for batch in batches:
        for i, bucket in enumerate(batch.column("_bpe_bucket").to_pylist()):
            ids = batch.column("_bpe_ids")[i].values
            each = np.concatenate([[0], np.asarray(pc.list_value_length(ids)).astype(np.int64)])
            start, flat = np.cumsum(each) - each, np.asarray(ids.flatten()).astype("<u4")
            codes = _wide(batch.column("_bpe_codes")[i].as_py())
            blocks, sizes = (batch.column(name)[i].as_py() for name in ("_bpe_blocks", "_bpe_sizes"))
            rows = []
            for block, code in zip(blocks, np.split(codes, np.cumsum(sizes)[:-1]), strict=True):
                own = flat[_spread(start[code], each[code])]
                rows.append((block, bucket, len(code), each[code].astype(np.uint8).tobytes() + _narrow(own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _REPLY, strict=True)], schema=_REPLY)


def _narrow(numbers: np.ndarray) -> bytes:
    """Numbers in two bytes each if they fit, else four, behind a byte that says which."""
    kind = "<u2" if numbers.max(initial=0) < 1 << 16 else "<u4"
    return kind[-1].encode() + numbers.astype(kind).tobytes()


def _wide(data: bytes, at: int = 0) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[at : at + 1].decode()}", offset=at + 1)


def _read_back(block: pa.Table, replies: pa.Table, fields: pa.Schema, vocabulary: Vocabulary, ranks: dict[bytes, int]) -> pa.Table:
    """Every text's ids from its word numbers and the ids of the block's words."""

    def of(kind: int) -> pa.Table:
        return block.filter(pc.equal(block["_bpe_kind"], kind))

    numbers, flat, sizes = [], [], []

    def known(codes: np.ndarray, ids: np.ndarray, each: np.ndarray) -> None:
        numbers.append(codes)
        flat.append(ids)
        sizes.append(each)

    for row in of(_KNOWN).to_pylist():
        codes = _unpack(row["_bpe_codes"])
        known(codes, _unpack(row["_bpe_words"]), np.full(len(codes), row["_bpe_width"], dtype=np.int64))
    answers = {row["_bpe_bucket"]: row["_bpe_ids"] for row in replies.to_pylist()}
    for row in of(_WORDS).to_pylist():
        codes, count, data = _unpack(row["_bpe_codes"]), row["_bpe_width"], answers[row["_bpe_number"]]
        each = np.frombuffer(data, dtype=np.uint8, count=count).astype(np.int64)
        ids = _wide(data, count)
        if len(codes) != count or each.sum() != len(ids):
            raise ValueError("a block's words and their ids don't match")
        known(codes[each > 0], ids, each[each > 0])
        # Words that too few blocks list were left to it.
        alone = np.flatnonzero(each == 0)
        own = [merge_word(word, ranks) for word in _part(count, row["_bpe_words"]).take(pa.array(alone)).to_pylist()]
        known(codes[alone], np.array([i for ids in own for i in ids], dtype=np.int32), np.array(list(map(len, own)), dtype=np.int64))

    texts = of(_TEXT)
    texts = texts.take(pc.sort_indices(texts["_bpe_number"]))
    lengths = np.asarray(texts["_bpe_width"]).astype(np.int64)
    packed = of(_CODES)
    packed = packed.take(pc.sort_indices(packed["_bpe_number"]))["_bpe_codes"].to_pylist()
    ids_of, counts = [np.empty(0, dtype=np.int32)], np.zeros(int(lengths.sum()), dtype=np.int32)
    if packed:
        order, each = np.concatenate(numbers), np.concatenate(sizes)
        all_ids = np.concatenate(flat).astype(np.int32)
        size, start = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        size[order], start[order] = each, np.cumsum(each) - each
        at = 0
        for codes in map(_unpack, packed):
            counts[at : at + len(codes)] = size[codes]
            at += len(codes)
            ids_of.append(all_ids[_spread(start[codes], size[codes])])
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[np.concatenate([[0], np.cumsum(lengths)])]
    ids = np.concatenate(ids_of)
    del ids_of, counts
    made = {name: _give(name, ids, ends, vocabulary) for name in OUTPUTS if name in fields.names}
    return pa.table([made[f.name] if f.name in made else texts[f.name] for f in fields], schema=fields)


def _give(name: str, ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> pa.Array:
    """One of ``OUTPUTS`` for texts whose ids lie one after the other."""
    if name == "token_ids":
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
    if name == "n_tokens":
        return pa.array(np.diff(ends), pa.int64())
    each = pa.array(vocabulary.pieces if name == "decoded" else [f"{i}," for i in range(len(vocabulary.pieces))], pa.binary())
    data, places, size = [], [], 0
    for at in range(0, len(ids) + 1, _RUN):
        joined = each.take(pa.array(ids[at : at + _RUN]))
        offsets = np.frombuffer(joined.buffers()[1], dtype=np.int32, count=len(joined) + 1)
        places.append(size + offsets[ends[(ends >= at) & (ends < at + _RUN)] - at].astype(np.int64))
        data.append(memoryview(joined.buffers()[2] or b"")[: int(offsets[-1])])
        size += int(offsets[-1])
    raw = b"".join(data)
    if name == "decoded":
        return _cut(raw, np.concatenate(places), pa.binary())
    return pc.ascii_rtrim(_cut(raw, np.concatenate(places), pa.string()), ",")


def encode_texts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    buckets: int | None = None,
    fold_from: int = 2,
    give: tuple[str, ...] = ("token_ids",),
) -> DataFrame:
    """``docs`` without its text, with ``token_ids``: the ids of each whole text, in order.

    Special tokens are not known: their strings are encoded like any text. A null or
    empty text has no ids. Other columns are carried; one named like an output is replaced.
    Rows must come in the same order if a task is repeated, as they do from files.

    ``give`` names the outputs: ``token_ids``, ``n_tokens``, ``ids_text`` (the ids as decimal
    numbers, comma-joined) and ``decoded`` (the bytes that the ids stand for).

    Words that at least ``fold_from`` blocks use are merged by Spark's fold; with 2, those
    that one block alone uses are merged in that block.
    """
    spark = docs.sparkSession
    buckets = buckets or max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = without(docs, [*give, *_OWN.names])
    carried = T.StructType([f for f in plain.schema.fields if f.name != text])
    carry = to_arrow_schema(carried)
    layout = pa.schema([*_OWN, *carry])
    spell: Callable = partial(_spell, vocabulary=vocabulary, text=text, buckets=buckets, schema=layout)
    blocks = plain.mapInArrow(spell, from_arrow_schema(layout))

    # Both uses below read every column, so Spark shuffles the blocks once and reads that twice.
    listed = blocks.groupBy("_bpe_block").applyInArrow(_only_words, _LISTED)
    ranks = vocabulary.ranks()
    single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
    met = listed.groupBy("_bpe_bucket").applyInArrow(lambda table: _meet(table, fold_from, single), from_arrow_schema(_MEETING))
    ranked = RankMap(vocabulary)
    folded = ranked.beside(met).withColumn("_bpe_ids", F.transform("_bpe_single", ranked.encode))
    # Dealt out again, so that no task has two Python workers at once.
    replies = folded.drop(*ranked.columns, "_bpe_single").repartition("_bpe_bucket").mapInArrow(_reply, from_arrow_schema(_REPLY))
    fields = pa.schema([*carry, *((name, OUTPUTS[name]) for name in give)])

    def read_back(block: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return _read_back(block, answers, fields, vocabulary, vocabulary.ranks())

    return blocks.groupBy("_bpe_block").cogroup(replies.groupBy("_bpe_block")).applyInArrow(read_back, from_arrow_schema(fields))


def decode_ids(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that ids stand for: their pieces, joined. Ids beyond the vocabulary add nothing."""
    pieces = F.split(F.lit(_SEPARATOR.join(piece.decode("latin-1") for piece in vocabulary.pieces)), _SEPARATOR)
    return F.encode(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""), "ISO-8859-1")


def token_digests(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in place of its text."""
    encoded = encode_texts(docs, vocabulary, text, give=("n_tokens", "ids_text", "decoded"))
    digests = {"ids_sha256": F.sha2("ids_text", 256), "decoded_sha256": F.sha2("decoded", 256)}
    return with_own(encoded, digests).drop("ids_text", "decoded")
