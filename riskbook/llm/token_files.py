"""Token ids in compressed binary blocks: an adaptive context-mixing range coder over whole documents.

A block holds whole documents, about ``BLOCK_IDS`` ids of them, and stands alone: the models start anew in
every block, and a crc32 covers its bytes. Inside, the ids are dealt to many lanes, each a stretch of the
block with a range coder of its own; one step codes the next id of every lane at once with array
operations, and all lanes teach the same models.

Models: orders 1 and 2 each predict one id from the id, or the two ids, before it, with a confidence; order 0
predicts every id by how often it came. Their predictions are mixed: the probability of an id is the weight of
the orders that predict it plus, for order 0, its share; the weights are learnt for each pair of
confidences. The coder first codes which order is right and, for order 0, then the id.

The files are Parquet tables of blocks in ascending order of id, so that Spark's writers commit them and any
store that Spark reads can hold them. Defined cases: a NULL text is an empty document, of the end id alone;
NULL ids come first; rows with equal ids stand in the order of their texts; repeated rows are documents of
their own; an empty table gives files without blocks. Only the named columns are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskbook.llm.common import stored

BLOCK_IDS = 6_000_000
LANES = 16384
LEAST_LANE = 128  # ids in a lane
MAGIC = b"CMR1"
HEADER = "<4sIIIII"  # magic, crc32 of what follows it, documents, ids, lanes, steps

MOST_PIECES = 250_000  # whose ids a worker remembers, some 220 bytes each
CONTEXT_BITS = 18
MOST_CONFIDENCE = 7
SLOT_BITS = 16
ID_BITS = 24
COARSE_BITS = 8
REFRESH = 8  # steps between new order-0 shares
_WORD = np.uint64(32)
_LOW_WORD = np.uint64(0xFFFFFFFF)
_LEAST_RANGE = np.uint64(1 << 32)
_SHARES = 2 * (MOST_CONFIDENCE + 1) ** 2


class Models:
    """The predictions of a block. Reader and writer call the same methods in the same order."""

    def __init__(self, lanes: int, vocabulary: int) -> None:
        self.vocabulary = vocabulary
        self.order1 = np.zeros(vocabulary, np.int32)  # 8 * predicted id + confidence
        self.order2 = np.zeros(1 << CONTEXT_BITS, np.int32)
        self.last = np.zeros(lanes, np.int32)
        self.place = np.zeros(lanes, np.int32)
        self.seen = np.zeros(vocabulary, np.int64)
        self.right = np.ones((_SHARES, 3), np.int64)  # how often order 0, 1, 2 was right
        self.refresh_shares(None)

    def refresh_shares(self, ids: np.ndarray | None) -> None:
        """Order-0 shares from all ids so far; every id keeps at least one part."""
        if ids is not None:
            self.seen += np.bincount(ids.ravel(), minlength=self.vocabulary)
        room = (1 << ID_BITS) - 2 * self.vocabulary
        parts = (self.seen * (room / max(1, int(self.seen.sum())))).astype(np.uint64)
        parts += np.uint64(1)
        self.ids = np.zeros(self.vocabulary + 1, np.uint64)
        np.cumsum(parts, out=self.ids[1:])
        self.ids[-1] = 1 << ID_BITS
        self.coarse = None

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ids in whose order-0 shares the values lie."""
        if self.coarse is None:  # the first id of every stretch of values, until the shares change
            self.coarse = np.searchsorted(self.ids, np.arange(0, (1 << ID_BITS) + 1, 1 << COARSE_BITS, dtype=np.uint64), "right") - 1
        stretch = (value >> np.uint64(COARSE_BITS)).astype(np.int64)
        found = self.coarse.take(stretch)
        several = np.flatnonzero(found != self.coarse.take(stretch + 1))
        found[several] = np.searchsorted(self.ids, value.take(several), "right") - 1
        return found

    def predict(self) -> np.ndarray:
        """Look both predictions up and give the row of the mixing weights of each lane."""
        self.entry1 = self.order1.take(self.last)
        self.entry2 = self.order2.take(self.place)
        self.guess1, self.sure1 = self.entry1 >> 3, self.entry1 & 7
        self.guess2, self.sure2 = self.entry2 >> 3, self.entry2 & 7
        row = (self.sure2 << 4) | (self.sure1 << 1)
        row += self.guess1 == self.guess2
        total = self.right.sum(axis=1, keepdims=True)
        parts = self.right * ((1 << SLOT_BITS) - 3) // total + 1
        self.slots = np.zeros((_SHARES, 4), np.uint64)
        np.cumsum(parts, axis=1, out=self.slots[:, 1:])
        self.slots[:, 3] = 1 << SLOT_BITS
        self.slots = self.slots.ravel()
        return row

    def learn(self, ids: np.ndarray, row: np.ndarray, slot: np.ndarray) -> None:
        self.right += np.bincount(row * 3 + slot, minlength=_SHARES * 3).reshape(-1, 3)
        fresh = ids << 3
        for table, at, entry, guess, sure in (
            (self.order1, self.last, self.entry1, self.guess1, self.sure1),
            (self.order2, self.place, self.entry2, self.guess2, self.sure2),
        ):
            hit = ids == guess
            # A hit adds one; a miss halves the confidence, and a doubtful guess gives way to the new id.
            worse = np.where(sure < 2, fresh, entry - ((sure + 1) >> 1))
            table[at] = np.where(hit, entry + (sure < MOST_CONFIDENCE), worse)
        self.place = ((self.last * 40503) ^ (ids * 2654435)) & ((1 << CONTEXT_BITS) - 1)
        self.last = ids


def _lanes(ids: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, ids // LEAST_LANE))
    return lanes, -(-ids // lanes)


class _Writer:
    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.words: list[np.ndarray] = []
        self.lanes: list[np.ndarray] = []

    def put(self, at: np.ndarray | None, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        low, range_ = (self.low, self.range) if at is None else (self.low.take(at), self.range.take(at))
        part = range_ >> np.uint64(bits)
        low = low + start * part
        range_ = size * part
        out = np.flatnonzero(range_ < _LEAST_RANGE)
        if len(out):
            l = low[out]
            # The range is cut where a later carry could reach a word already written.
            g = np.minimum(range_[out], _LEAST_RANGE - (l & _LOW_WORD))
            self.words.append((l >> _WORD).astype(np.uint32))
            self.lanes.append((out if at is None else at[out]).astype(np.uint16))
            low[out] = l << _WORD
            range_[out] = g << _WORD
        if at is None:
            self.low, self.range = low, range_
        else:
            self.low[at] = low
            self.range[at] = range_

    def streams(self) -> tuple[np.ndarray, np.ndarray]:
        """Words per lane, and all words lane after lane."""
        every = np.arange(len(self.low), dtype=np.uint16)
        words = np.concatenate([*self.words, (self.low >> _WORD).astype(np.uint32), self.low.astype(np.uint32)])
        lanes = np.concatenate([*self.lanes, every, every])
        return np.bincount(lanes, minlength=len(self.low)), words[np.argsort(lanes, kind="stable")]


class _Reader:
    def __init__(self, lengths: np.ndarray, words: np.ndarray) -> None:
        self.words = np.append(words, [0, 0]).astype(np.uint64)
        self.at = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.code = (self.words.take(self.at) << _WORD) | self.words.take(self.at + 1)
        self.at += 2
        self.low = np.zeros(len(lengths), np.uint64)
        self.range = np.full(len(lengths), 0xFFFFFFFFFFFFFFFF, np.uint64)

    def look(self, at: np.ndarray | None, bits: int) -> np.ndarray:
        """Where the code stands within the range of each lane, in parts of 2**bits."""
        low, range_ = (self.low, self.range) if at is None else (self.low.take(at), self.range.take(at))
        code = self.code if at is None else self.code.take(at)
        self.part = range_ >> np.uint64(bits)
        return np.minimum((code - low) // self.part, np.uint64((1 << bits) - 1))

    def take(self, at: np.ndarray | None, start: np.ndarray, size: np.ndarray) -> None:
        low = (self.low if at is None else self.low.take(at)) + start * self.part
        range_ = size * self.part
        out = np.flatnonzero(range_ < _LEAST_RANGE)
        if len(out):
            l = low[out]
            g = np.minimum(range_[out], _LEAST_RANGE - (l & _LOW_WORD))
            low[out] = l << _WORD
            range_[out] = g << _WORD
            lanes = out if at is None else at[out]
            self.code[lanes] = (self.code[lanes] << _WORD) | self.words.take(self.at[lanes])
            self.at[lanes] += 1
        if at is None:
            self.low, self.range = low, range_
        else:
            self.low[at] = low
            self.range[at] = range_


def encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Lanes, steps, words per lane, words."""
    lanes, steps = _lanes(len(ids))
    rows = np.zeros((steps, lanes), np.int32)
    whole = len(ids) // steps  # lanes without padding
    rows[:, :whole] = ids[: whole * steps].reshape(whole, steps).T
    rows[: len(ids) - whole * steps, whole : whole + 1] = ids[whole * steps :, None]
    models, writer = Models(lanes, vocabulary), _Writer(lanes)
    for step in range(steps):
        now = rows[step]
        row = models.predict()
        slot = (now == models.guess1).astype(np.int64)
        slot[now == models.guess2] = 2
        place = (row << 2) + slot
        start = models.slots.take(place)
        writer.put(None, start, models.slots.take(place + 1) - start, SLOT_BITS)
        rest = np.flatnonzero(slot == 0)
        if len(rest):
            value = now.take(rest)
            start = models.ids.take(value)
            writer.put(rest, start, models.ids.take(value + 1) - start, ID_BITS)
        models.learn(now, row, slot)
        if (step + 1) % REFRESH == 0:
            models.refresh_shares(rows[step + 1 - REFRESH : step + 1])
    return lanes, steps, *writer.streams()


def decode_ids(n: int, lanes: int, steps: int, lengths: np.ndarray, words: np.ndarray, vocabulary: int) -> np.ndarray:
    rows = np.empty((steps, lanes), np.int32)
    models, reader = Models(lanes, vocabulary), _Reader(lengths, words)
    for step in range(steps):
        row = models.predict()
        place = row << 2
        value = reader.look(None, SLOT_BITS)
        slot = (value >= models.slots.take(place + 1)).astype(np.int64)
        slot += value >= models.slots.take(place + 2)
        place += slot
        start = models.slots.take(place)
        reader.take(None, start, models.slots.take(place + 1) - start)
        now = np.where(slot == 2, models.guess2, models.guess1)
        rest = np.flatnonzero(slot == 0)
        if len(rest):
            value = models.find(reader.look(rest, ID_BITS))
            start = models.ids.take(value)
            reader.take(rest, start, models.ids.take(value + 1) - start)
            now[rest] = value
        rows[step] = now
        models.learn(now, row, slot)
        if (step + 1) % REFRESH == 0:
            models.refresh_shares(rows[step + 1 - REFRESH : step + 1])
    return rows.T.ravel()[:n]


def write_block(keys: list[int | None], lengths: list[int], ids: np.ndarray, vocabulary: int) -> bytes:
    """A block of documents: header, their ids' counts and keys, and the coded ids."""
    lanes, steps, per_lane, words = encode_ids(ids, vocabulary) if len(ids) else (0, 0, np.zeros(0), np.zeros(0))
    body = b"".join(
        [
            np.array([k is not None for k in keys], np.uint8).tobytes(),
            np.array([k or 0 for k in keys], np.int64).tobytes(),
            np.array(lengths, np.int64).tobytes(),
            np.asarray(per_lane, np.uint32).tobytes(),
            np.asarray(words, np.uint32).tobytes(),
        ]
    )
    head = struct.pack(HEADER, MAGIC, 0, len(keys), len(ids), lanes, steps)
    return head[:4] + struct.pack("<I", zlib.crc32(head[8:] + body)) + head[8:] + body


def read_block(block: bytes, vocabulary: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Keys, counts and ids of the documents of a block; a damaged block raises ValueError."""
    magic, crc, documents, n, lanes, steps = struct.unpack_from(HEADER, block)
    if magic != MAGIC or zlib.crc32(block[8:]) != crc:
        raise ValueError("damaged block")
    at = struct.calcsize(HEADER)
    parts = []
    for count, kind in ((documents, np.uint8), (documents, np.int64), (documents, np.int64), (lanes, np.uint32)):
        parts.append(np.frombuffer(block, kind, count, at))
        at += parts[-1].nbytes
    words = np.frombuffer(block, np.uint32, -1, at) if at < len(block) else np.zeros(0, np.uint32)
    known, keys, lengths, per_lane = parts
    ids = decode_ids(n, lanes, steps, per_lane, words, vocabulary) if n else np.zeros(0, np.int64)
    return [int(k) if ok else None for ok, k in zip(known, keys)], lengths, ids


# Byte-level vocabularies spell the bytes that are no printable Latin-1 characters from code point 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_SPELLED = {c: "".join(chr(_BYTE_LETTERS.get(b, b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


# Of the UTF-8 bytes of a plain text: white space (0), letters with all bytes of Latin-1 ones (1), anything else (2).
_KIND = np.full(256, 2, np.uint8)
_KIND[[*b" \t\n\v\f\r"]] = 0
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Bytes that no plain text has: the apostrophe and all that begin other characters than U+00C0 to U+00FF.
_ODD = np.zeros(256, bool)
_ODD[[ord("'"), *range(0xC0, 0xC3), *range(0xC4, 0x100)]] = True


class _Numbers(dict):
    """Pieces numbered as they come; ``new`` holds those whose ids are still to be learnt."""

    def __init__(self, known: Iterable[tuple[str, int]] = ()) -> None:
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Texts to ids with a tokenizers file, remembering the ids of pieces.

    White space is no token of these vocabularies and no token crosses it, so a text is the sequence of its
    pieces between white space. Where a text has only ASCII and Latin-1 letters and no apostrophes or
    special tokens, runs of letters and of anything else are separate pieces too, in lower case, as
    the tokenizer itself would part them. Beyond ``most`` pieces, those are dropped that no later texts held.
    """

    _PIECE = re.compile(r"[^ \t-\r]+")
    _PLAIN = re.compile(r"[\x00-&(-\x7F\xC0-\xD6\xD8-\xF6\xF8-\xFF]*")
    _PLAIN_PIECE = re.compile(r"[a-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+|[^ \t-\ra-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+")

    _LETTERS = re.compile(r"[a-z\xDF-\xF6\xF8-\xFF]+")

    def __init__(self, path: str, most: int = MOST_PIECES) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokenize = self.tokenizer.model.tokenize
        self.most = most
        self.forget()
        self.direct = False
        probe = ["abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0xE0, 0xF7))), "überprüfung", "façade"]
        full = [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.direct = full == [self._letters(piece) for piece in probe]

    def _letters(self, piece: str) -> list[int]:
        """The ids of a run of lower-case letters from the model alone, as it spells their bytes."""
        if not piece.isascii():
            piece = piece.translate(_SPELLED)
        return [token.id for token in self.tokenize(piece)]

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # whether texts after those that brought the piece held it too

    def _trim(self) -> None:
        """Keep the pieces that came again; where these alone are too many, begin anew."""
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > self.most:
            self.forget()
            return
        names = list(self.numbers)
        self.numbers = _Numbers(zip([names[i] for i in kept.tolist()], range(len(kept))))
        self.flat, lengths = self._ids_at(kept)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.again = np.zeros(len(kept), bool)

    def _ids_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces one after the other, and how many each has."""
        starts = self.starts.take(at)
        lengths = self.starts.take(at + 1) - starts
        ends = np.cumsum(lengths)
        # Id i of the output stands at its offset within its piece, from the piece's start.
        place = np.repeat(starts - ends + lengths, lengths)
        place += np.arange(len(place))
        return self.flat.take(place), lengths

    def pieces(self, text: str) -> list[str]:
        if self._PLAIN.fullmatch(text) and "<|" not in text:
            return self._PLAIN_PIECE.findall(text.lower())
        return self._PIECE.findall(text)

    def _learn(self, new: list[str]) -> None:
        rest = [p for p in new if not (self.direct and self._LETTERS.fullmatch(p))]
        encoded = dict(zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)))
        found = [encoded[p].ids if p in encoded else self._letters(p) for p in new]
        ids = np.fromiter(chain.from_iterable(found), np.int32)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])

    def _plain_pieces(self, column: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
        """Which texts are plain, how many pieces each of them has, and these one after the other, from the bytes of all texts."""
        _, offsets, data = column.buffers()
        starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data or b"", np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        before, after = raw[:-1], raw[1:]
        odd = _ODD.take(raw)
        odd[1:] |= (before == ord("<")) & (after == ord("|"))
        low = _LOWER.take(raw)
        accents = np.flatnonzero(before == 0xC3) + 1
        accent = raw.take(accents)
        odd[accents] |= (accent == 0x97) | (accent == 0xB7)
        low[accents] += np.where(accent <= 0x9E, 0x20, 0).astype(np.uint8)
        plain = np.ones(len(column), bool)
        plain[np.searchsorted(starts[1:], np.flatnonzero(odd), "right")] = False

        kind = _KIND.take(raw)
        begins = np.ones(len(raw), bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins[starts[starts < len(raw)]] = True
        kept = kind != 0
        if not plain.all():
            kept &= np.repeat(plain, np.diff(starts))
        counts = np.diff(np.searchsorted(np.flatnonzero(begins & kept), starts))
        solid = low[kept]
        bounds = np.append(np.flatnonzero(begins[kept]), len(solid)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(solid))
        return plain, counts, pieces.dictionary_encode()

    def encode(self, texts: Sequence[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        if len(self.numbers) > self.most:
            self._trim()
        column = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string())
        known = len(self.numbers)
        plain, counts, pieces = self._plain_pieces(column)
        # A piece is looked up once, however often these texts hold it.
        named = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.__getitem__, named), np.int64, len(named))
        at = numbers.take(pieces.indices.to_numpy())
        if not plain.all():
            by_text = [self.pieces(column[i].as_py()) for i in np.flatnonzero(~plain).tolist()]
            counts[~plain] = list(map(len, by_text))
            every = np.empty(int(counts.sum()), np.int64)
            own = np.repeat(plain, counts)
            every[own] = at
            every[~own] = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(by_text)), np.int64)
            at = every
        self.again[at[at < known]] = True
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        flat, lengths = self._ids_at(at)
        text_ends = np.concatenate([[0], np.cumsum(lengths)]).take(np.cumsum(counts))
        return flat, np.diff(text_ends, prepend=0)


def _encoder(path: str) -> Encoder:
    """The encoder of this worker process, which serves all tasks that the process runs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_riskbook_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


_BLOCK_FIELDS = [
    pa.field("shard", pa.int32()), pa.field("number", pa.int32()), pa.field("documents", pa.int64()),
    pa.field("ids", pa.int64()), pa.field("block", pa.binary()),
]
_BLOCK_SCHEMA = "shard int, number int, documents bigint, ids bigint, block binary"
_BYTES_AT_ONCE = 2_000_000  # of texts encoded together, and one text more at most


def encode_blocks(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the file: one per block, in ascending order of (shard, number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder = _encoder(path)
        keys: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        gathered = number = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            parts.clear()
            data = write_block(keys, lengths, ids, encoder.vocabulary)
            values = ([shard], [number], [len(keys)], [gathered], [data])
            arrays = [pa.array(v, f.type) for v, f in zip(values, _BLOCK_FIELDS)]
            return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(_BLOCK_FIELDS))

        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            size = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // _BYTES_AT_ONCE
            cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), batch.num_rows]
            for at, end in zip(cuts, cuts[1:]):
                piece = batch.slice(at, end - at)
                flat, sizes = encoder.encode(texts.slice(at, end - at))
                ends = np.cumsum(sizes)
                # An end id after each document.
                with_ends = np.insert(flat, ends, end_id)
                keys += piece.column(0).to_pylist()
                lengths += (sizes + 1).tolist()
                parts.append(with_ends)
                gathered += len(with_ends)
                if gathered >= BLOCK_IDS:
                    yield block()
                    keys, lengths, parts, gathered, number = [], [], [], 0, number + 1
        if keys:
            yield block()

    ordered = (
        docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("key", "tie")
        .sortWithinPartitions("key", "tie", "text")
        .select("key", "text")
    )
    return ordered.mapInArrow(run, _BLOCK_SCHEMA)


def write_files(docs: DataFrame, folder: str, path: str, end_id: int, **columns) -> None:
    encode_blocks(docs, path, end_id, **columns).write.parquet(folder)


def read_documents(blocks: DataFrame, vocabulary: int, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, lengths, ids = read_block(row["block"], vocabulary)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = ids.astype("<u4").data.cast("B")
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["number"]] * n, pa.int32()),
                        pa.array(keys, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["shard", "number", "key", "inside", "n_tokens", "ids_crc32"],
                )

    decoded = blocks.select("shard", "number", "block").mapInArrow(
        run, "shard int, number int, key bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # Prefix sums from the counts alone: over the shards (one row each), then over the blocks of a shard.
    counts = blocks.select(F.col("shard").alias("s"), F.col("number").alias("n"), "ids")
    shards = counts.groupBy("s").agg(F.sum("ids").alias("shard_ids"))
    before = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    shards = shards.select(
        F.col("s").alias("shard_of"), (F.sum("shard_ids").over(before) - F.col("shard_ids")).alias("shard_start")
    )
    within = Window.partitionBy("s").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    starts = (
        counts.withColumn("block_start", F.sum("ids").over(within) - F.col("ids"))
        .join(shards, F.col("s") == F.col("shard_of"))
        .select("s", "n", (F.col("block_start") + F.col("shard_start")).alias("block_start"))
    )
    placed = decoded.join(starts, (F.col("shard") == F.col("s")) & (F.col("number") == F.col("n")))
    return placed.select(
        F.col("key").alias(key), (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(blocks: DataFrame, vocabulary: int, key: str = "doc_id") -> DataFrame:
    """Per document of the files: key and its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0):
                keys, lengths, ids = read_block(block.as_py(), vocabulary)
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))],
                    ["key", "ids"],
                )

    return blocks.select("block").mapInArrow(run, "key bigint, ids array<int>").withColumnRenamed("key", key)


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def tokenized(docs: DataFrame, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``docs`` into the shared folder and describe each document from them."""
    blocks = stored(encode_blocks(docs, path, end_id, key=key, text=text), "tokens")
    return read_documents(blocks, vocabulary_size(path), key)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_BLOCK_SCHEMA).parquet(folder)
