"""Byte-level BPE with the tokenizers library over Arrow batches: encoding, offsets and decoding.

A whole text is cut where no token can cross: between a character that is not white space and white space
after it, and between a letter or digit and a comma or full stop. The library encodes each distinct piece once;
a table of bounded size keeps pieces and their ids for later batches and tasks of the worker. Pieces are found by a fast hash
and then compared byte by byte, so pieces that share a hash keep ids of their own.
New pieces go to the library many in one text where the same rule cuts between them, and the tokens' bytes tell whose
ids are whose. The ids are those of the whole text, which tests compare.

Decoding reverses the byte table. A character that is split over tokens belongs to each of them in the offsets, and to the
last one in decode_pieces().

Defined cases: a null text counts as empty and has no tokens; a text of any length is one row, worked through in windows; repeated
rows are encoded alike; an empty table gives an empty result; other columns pass through where a function says so, and
those with the name of a result are replaced.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, process_cache, sliced
from .shingles import WINDOW, distinct_spans, equal_spans

#: Pieces that a worker remembers (about 50 bytes each), bytes of them and ids, and new pieces that the library gets in one text.
PIECES, JOINED = 700_000, 128
_WHITE, _WORD = np.zeros(256, bool), np.zeros(256, bool)
_WHITE[[9, 10, 13, 32]] = True
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: The last three bytes of a text's white space of other kinds, as far as each kind has them.
_ODD1 = np.isin(np.arange(256), [11, 12, 28, 29, 30, 31])
_ODD2 = np.array([0xC285, 0xC2A0])
_ODD3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def _cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a piece of a text begins at each byte: at a blank, tab or line end after a character that is no white space of
    any kind, and at a comma or full stop after an ASCII letter or digit. Four bytes before suffice to tell."""
    white = _WHITE[raw]
    cut = np.zeros(len(raw), bool)
    cut[1:] = white[1:] & ~white[:-1]
    cut[1:] |= ((raw[1:] == 44) | (raw[1:] == 46)) & _WORD[raw[:-1]]
    at = np.flatnonzero(cut & white)
    last = raw[at - 1]
    odd = _ODD1[last]
    far = np.flatnonzero(last >= 0x80)
    if len(far):
        i = at[far]
        two = raw[i - 2].astype(np.int64) << 8 | raw[i - 1]
        three = raw[np.maximum(i - 3, 0)].astype(np.int64) << 16 | two
        odd[far] = np.isin(two, _ODD2) | np.isin(three, _ODD3)
    cut[at[odd]] = False
    return cut


def _piece_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of all rows begin."""
    heads = offsets[:-1][np.diff(offsets) > 0]
    found = [heads]
    for lo in range(0, len(raw), WINDOW):
        low = max(0, lo - 4)
        cut = _cuts(raw[low : lo + WINDOW])
        cut[: lo - low] = False
        found.append(np.flatnonzero(cut) + low)
    if len(found) == 2:
        cut = np.zeros(len(raw), bool)
        cut[found[1]] = cut[heads] = True
        return np.flatnonzero(cut)
    return np.unique(np.concatenate(found))


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable
    and no space, else the next one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The content of a rank file: base64 bytes and rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def from_ranks(data: bytes, pattern: str):
    """A tokenizer of the library that merges by the ranks of a rank file, and its byte table."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = read_ranks(data)
    chars = byte_chars()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for t in sorted(ranks, key=ranks.get):
        cuts = [(t[:k], t[k:]) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        merges += [(name[a], name[b]) for a, b in sorted(cuts, key=lambda x: (ranks[x[0]], ranks[x[1]]))]
    tok = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    table: list[bytes] = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        table[r] = t
    return tok, table


def from_json(data: bytes):
    """A tokenizer of the library from its own file, as the library sets it up, and its byte table. The strings of added
    tokens are those tokens; none of them has a place where pieces are cut."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(data.decode())
    for t in tok.get_added_tokens_decoder().values():
        if t.lstrip or t.rstrip or t.single_word or _cuts(np.frombuffer(b"x" + t.content.encode() + b"x", np.uint8)).any():
            raise ValueError(f"texts cannot be cut around the added token {t.content!r}")
    back = {c: b for b, c in enumerate(byte_chars())}
    vocab = tok.get_vocab(with_added_tokens=True)
    table: list[bytes] = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        table[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
    return tok, table


class _Pieces:
    """The ids of pieces, in flat arrays; found by hash and compared byte by byte. It starts anew beyond its bounds."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.at, self.sizes, self.data = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def full(self, more: int) -> bool:
        return len(self.keys) + more > PIECES or len(self.flat) > 8 * PIECES or len(self.data) > 24 * PIECES

    def find(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The row of each span of raw, -1 if it is unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        rows = np.where(self.keys[at] == keys, self.rows[at], -1)
        hit = np.flatnonzero(rows >= 0)
        same = equal_spans(raw, starts[hit], sizes[hit], self.data, self.at[rows[hit]], self.sizes[rows[hit]])
        rows[hit[~same]] = -1
        return rows

    def add(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The rows of new spans of raw; flat: the ids of all of them, counts of them each. A key that is there already keeps
        its first piece, and the new one is found by its row only."""
        rows = len(self.starts) + np.arange(len(keys))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, flat])
        ends = np.cumsum(sizes)
        held = raw[np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts - ends + sizes, sizes)]
        self.at = np.concatenate([self.at, len(self.data) + ends - sizes])
        self.sizes, self.data = np.concatenate([self.sizes, sizes]), np.concatenate([self.data, held])
        every, first = np.unique(np.concatenate([self.keys, keys]), return_index=True)
        self.keys, self.rows = every, np.concatenate([self.rows, rows])[first]
        return rows


class Codec:
    """Encodes and decodes texts of a batch. pattern: given for a rank file, None for the library's file."""

    def __init__(self, data: bytes, pattern: str | None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, self.table = from_ranks(data, pattern) if pattern else from_json(data)
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self.flat, self.table_at = np.frombuffer(b"".join(self.table), np.uint8), np.cumsum(self.sizes) - self.sizes
        self.pieces = _Pieces()

    @classmethod
    def of(cls, data: bytes, pattern: str | None) -> Codec:
        """The worker's codec for a file; kept over tasks."""
        key = ("codec", hashlib.sha1(data).hexdigest(), pattern)
        cache = process_cache()
        if key not in cache:
            cache[key] = cls(data, pattern)
        return cache[key]

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _encode_new(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces raw[starts:ends], their ids in that order in one array, and how many each has. A piece that
        begins with white space may follow one that ends with an ASCII character that is none."""
        last = raw[ends - 1]
        joins = _WHITE[raw[starts]] & (last < 0x80) & ~_WHITE[last] & ~_ODD1[last]
        order, m = np.argsort(~joins, kind="stable"), int(joins.sum())
        data = raw.tobytes()
        pieces = [data[a:z] for a, z in zip(starts[order].tolist(), ends[order].tolist(), strict=True)]
        alone = self._ids(pieces[m:])
        flat = np.concatenate([np.zeros(0, np.uint32), *self._ids([b"".join(pieces[i : min(i + JOINED, m)]) for i in range(0, m, JOINED)])])
        token_ends, piece_ends = np.cumsum(self.sizes[flat]), np.cumsum([len(p) for p in pieces[:m]], dtype=np.int64)
        cut = np.searchsorted(token_ends, piece_ends)
        if m and (token_ends[-1] != piece_ends[-1] or (token_ends[cut] != piece_ends).any()):  # tokens that do not spell the text
            alone, m = self._ids(pieces[:m]) + alone, 0
            flat, cut = flat[:0], cut[:0]
        counts = np.concatenate([np.diff(cut, prepend=-1), np.array([len(x) for x in alone], np.int64)])
        return order, np.concatenate([flat, *alone]), counts

    def _encode_window(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces raw[starts:ends] in one array, and how many each has."""
        keys, first, back = distinct_spans(raw, starts, ends)
        at, sizes = starts[first], (ends - starts)[first]
        rows = self.pieces.find(keys, raw, at, sizes)
        new = np.flatnonzero(rows < 0)
        if len(new) and self.pieces.full(len(new)):
            self.pieces.clear()
            new = np.arange(len(keys))
        if len(new):
            order, flat, counts = self._encode_new(raw, at[new], at[new] + sizes[new])
            new = new[order]
            rows[new] = self.pieces.add(keys[new], raw, at[new], sizes[new], flat, counts)
        row = rows[back]
        counts = self.pieces.counts[row]
        ends = np.cumsum(counts)
        inside = np.arange(ends[-1]) + np.repeat(self.pieces.starts[row] - ends + counts, counts)
        return self.pieces.flat[inside], counts

    def encode_bytes(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows' texts in one uint32 array, and where each row's begin (one more at the end)."""
        n = len(raw)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = _piece_starts(raw, offsets)
        ends = np.append(starts[1:], n)
        found, counted, at = [], [], 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + WINDOW, "right")))
            low, high = starts[at], ends[to - 1]
            ids, counts = self._encode_window(raw[low:high], starts[at:to] - low, ends[at:to] - low)
            found.append(ids)
            counted.append(counts)
            at = to
        before = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(np.concatenate(counted), out=before[1:])
        return found[0] if len(found) == 1 else np.concatenate(found), before[np.searchsorted(starts, offsets)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text, as little-endian unsigned 32-bit integers."""
        coded = [t.encode() for t in texts]
        offsets = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(c) for c in coded], out=offsets[1:])
        ids, at = self.encode_bytes(np.frombuffer(b"".join(coded), np.uint8), offsets)
        return [ids[a:z].astype("<u4").tobytes() for a, z in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode_pieces(self, ids: Iterable[int]) -> list[str]:
        """The characters that each token completes; a character split over tokens belongs to its last one, and bytes
        that are no UTF-8 become U+FFFD."""
        step = codecs.getincrementaldecoder("utf-8")("replace")
        out = [step.decode(self.table[i]) for i in ids]
        if out:
            out[-1] += step.decode(b"", True)
        return out

    def decode_bytes(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all rows' ids in one array by the reversed byte table, and where each row's begin."""
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=ends[1:])
        out = np.empty(ends[-1], np.uint8)
        for lo in range(0, len(ids), WINDOW >> 3):
            part = ids[lo : lo + (WINDOW >> 3)]
            low, high = ends[lo], ends[lo + len(part)]
            out[low:high] = self.flat[np.arange(high - low) + np.repeat(self.table_at[part] - ends[lo : lo + len(part)] + low, self.sizes[part])]
        return out, ends[at]

    def offsets(self, raw: np.ndarray, rows: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token of all rows the characters of its row's text that it touches, as [start, end), and whether it ends
        inside a character. raw, rows: the texts' bytes and where they begin; ids, at: theirs."""
        chars = np.zeros(len(raw) + 1, np.int32)
        np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
        ends = np.cumsum(self.sizes[ids])
        begins = ends - self.sizes[ids]
        base = np.repeat(chars[rows[:-1]], np.diff(at))
        start, end = chars[begins + 1] - 1 - base, chars[ends] - base
        split = np.zeros(len(ids), bool)
        inner = np.flatnonzero(ends < np.repeat(rows[1:], np.diff(at)))
        split[inner] = (raw[ends[inner]] & 0xC0) == 0x80
        return start, end, split


def lists(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """32-bit ids of rows that begin at `at` as a list column."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))


def rows_of(ids: pa.Array) -> list[np.ndarray]:
    """The int32 arrays of a list column, without copies; null is empty."""
    flat = ids.values.to_numpy(zero_copy_only=False)
    offs = ids.offsets.to_numpy()
    return [flat[a:z] for a, z in zip(offs[:-1], offs[1:], strict=True)]


def read_file(path: str) -> bytes:
    """A tokenizer file of the driver (2 MB); its content goes along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, pattern: str | None = None, text_col: str = "text", offsets: bool = False) -> DataFrame:
    """docs with ids (array<int>), and with char_start and char_end (array<int>) of each token if offsets is
    set; a column of docs with such a name is replaced. path: a rank file with its split pattern, or a file of
    the library without."""
    data = docs.sparkSession.sparkContext.broadcast(read_file(path))
    extra = ["ids", "char_start", "char_end"][: 3 if offsets else 1]
    kept = [c for c in docs.columns if c not in extra]
    schema = docs.select(kept).withColumns({c: F.array().cast("array<int>") for c in extra}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern)
        for batch in sliced(batches, text_col):
            raw, rows = bytes_of(batch.column(text_col))
            ids, at = codec.encode_bytes(raw, rows)
            out = [batch.column(c) for c in kept] + [lists(ids, at)]
            if offsets:
                start, end, _ = codec.offsets(raw, rows, ids, at)
                out += [lists(start, at), lists(end, at)]
            yield pa.RecordBatch.from_arrays(out, [*kept, *extra])

    return docs.select(kept).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str | None = None, ids_col: str = "ids") -> DataFrame:
    """tokens with decoded (binary): the bytes of its ids by the reversed byte table; a column of that name is replaced."""
    data = tokens.sparkSession.sparkContext.broadcast(read_file(path))
    kept = [c for c in tokens.columns if c != "decoded"]
    schema = tokens.select(kept).withColumn("decoded", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                raw = [codec.decode(r.tolist()) for r in rows_of(part.column(ids_col))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(raw, pa.binary())], [*kept, "decoded"])

    return tokens.select(kept).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str | None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text, whose ids are decoded again; offsets_sha256 of its tokens'
    [start, end) characters as little-endian 32-bit integers; and n_split, the tokens that end inside a character."""
    data = docs.sparkSession.sparkContext.broadcast(read_file(path))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "n_split"]
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern)
        for batch in sliced(batches, "text"):
            raw, rows = bytes_of(batch.column("text"))
            ids, at = codec.encode_bytes(raw, rows)
            back, places = codec.decode_bytes(ids, at)
            start, end, split = codec.offsets(raw, rows, ids, at)
            spans, sent = np.stack([start, end], 1).astype("<i4"), ids.astype("<u4", copy=False)
            splits = np.concatenate([[0], np.cumsum(split)])
            cut = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            out = [
                batch.column("doc_id"), pa.array(np.diff(at)), pa.array([sha(sent[a:z]) for a, z in cut], pa.string()),
                pa.array([sha(back[a:z]) for a, z in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)], pa.string()),
                pa.array([sha(spans[a:z]) for a, z in cut], pa.string()), pa.array(splits[at[1:]] - splits[at[:-1]]),
            ]
            yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string, n_split long")


def encoded_and_checked(docs: DataFrame, path: str, pattern: str | None, keep: list[str]) -> DataFrame:
    """The columns keep of docs with n_tokens, ids, and round_trip: whether the decoded ids give the text again."""
    data = docs.sparkSession.sparkContext.broadcast(read_file(path))
    schema = docs.select(keep).withColumns({"n_tokens": F.lit(0).cast("long"), "ids": F.array().cast("array<int>"), "round_trip": F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern)
        for batch in sliced(batches, "__text"):
            raw, rows = bytes_of(batch.column("__text"))
            ids, at = codec.encode_bytes(raw, rows)
            back, places = codec.decode_bytes(ids, at)
            whole = np.array_equal(back, raw) and np.array_equal(places, rows)
            same = [True] * batch.num_rows if whole else [np.array_equal(back[p:q], raw[a:z]) for p, q, a, z in zip(places[:-1], places[1:], rows[:-1], rows[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(np.diff(at)), lists(ids, at), pa.array(same)], [*keep, "n_tokens", "ids", "round_trip"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)
