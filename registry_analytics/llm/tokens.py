"""Token ids of an Arrow string column by a public tokenizer, at the cost of its distinct words.

Every text is cut at ASCII white space and between ASCII letters or digits and ASCII punctuation.
Where the tokenizer's own pre-tokenizer cuts there too, a text's ids are its pieces' ids in order; the
tokenizer encodes each piece once per worker, and the cache starts anew when it reaches ``CACHE``
pieces. Other tokenizers get whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .spans import SpanHash, gather, rows_of, string_bytes, worker_cache

#: Pieces that a worker keeps at most (about 100 bytes each).
CACHE = 1_000_000
END_ID = 1

#: Byte classes: 0 white space, 1 ASCII letter or digit, 2 punctuation that may end a piece, 3 what stays with its neighbours.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_CLASS[[c for c in range(33, 127) if chr(c) in '!"#$%&()*+,-./:;=?@[\\]^_`{}~']] = 2


def load_tokenizer(path: str):
    """The tokenizer at ``path``, kept per worker."""
    cache = worker_cache("tokens")
    if ("tokenizer", path) not in cache:
        from tokenizers import Tokenizer

        cache["tokenizer", path] = Tokenizer.from_file(path)
    return cache["tokenizer", path]


def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def encode_pieces(pieces: list[str], path: str) -> list[list[int]]:
    """Ids of each piece. A piece of lower-case letters alone is one pre-token: the tokenizer's model takes it directly."""
    cache = worker_cache("tokens")
    tokenizer = load_tokenizer(path)
    if ("model", path) not in cache:
        pre = str(tokenizer.pre_tokenizer)
        cache["model", path] = tokenizer.model if "ByteLevel" in pre and "add_prefix_space=False" in pre else None
        cache["letters"] = dict(enumerate(byte_letters()))
    model, letters = cache["model", path], cache["letters"]
    out: list[list[int] | None] = [None] * len(pieces)
    rest = []
    for i, piece in enumerate(pieces):
        if model is not None and piece.isalpha() and piece == piece.lower() and (piece.isascii() or max(piece) < "\u0250"):
            out[i] = [t.id for t in model.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(letters))]
        else:
            rest.append(i)
    if rest:
        for i, e in zip(rest, tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
    return out


def cuts_into_pieces(path: str) -> bool:
    """Whether the tokenizer drops white space and case and ends its words where a piece ends; else whole texts are encoded."""
    cache = worker_cache("tokens")
    if ("cuts", path) not in cache:
        ids = lambda text: load_tokenizer(path).encode(text, add_special_tokens=False).ids
        parts = ["some", ",", "words", "(", "12", ")", "été", "again"]
        cache["cuts", path] = ids(" Some,\n words  (12)\tété  AGAIN ") == [i for p in parts for i in ids(p)]
    return cache["cuts", path]


class PieceIds:
    """Ids of pieces by their hash: a sorted table, and one that gathers what is new."""

    def __init__(self):
        self.keys, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def add(self, keys: np.ndarray, encoded: list[list[int]]) -> None:
        count = np.fromiter(map(len, encoded), np.int64, len(encoded))
        start = len(self.ids) + np.cumsum(count) - count
        flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(count.sum()))
        self.ids = np.concatenate([self.ids, flat])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.count = np.insert(self.keys, at, keys), np.insert(self.start, at, start), np.insert(self.count, at, count)


def piece_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces; pieces never cross rows."""
    kind = _CLASS[data]
    cut = np.ones(len(data) + 1, bool)
    if len(data):
        a, b = kind[:-1], kind[1:]
        cut[1:-1] = (a == 0) | (b == 0) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
        cut[offsets] = True
    at = np.flatnonzero(cut)
    start, end = at[:-1], at[1:]
    word = kind[start] != 0
    return start[word], end[word]


def encode_slice(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets of the rows in ids), without end ids; a null text has none."""
    data, offsets = string_bytes(column)
    n = len(offsets) - 1
    if len(data) == 0:
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    if not cuts_into_pieces(path):
        encoded = load_tokenizer(path).encode_batch_fast([t or "" for t in column.to_pylist()], add_special_tokens=False)
        count = np.fromiter((len(e.ids) for e in encoded), np.int64, n)
        return np.fromiter((i for e in encoded for i in e.ids), np.uint32, int(count.sum())), np.concatenate([[0], np.cumsum(count)])
    start, end = piece_bounds(data, offsets)
    raw = data.tobytes()
    if b"<|" not in raw:  # no special token's text: the tokenizer lower-cases, so pieces may be told apart by lower case
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        raw = data.tobytes()
    keys = SpanHash(data)(start, end)
    distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
    table = worker_cache("tokens").setdefault(("pieces", path), PieceIds())
    at = np.searchsorted(table.keys, distinct)
    known = at < len(table.keys)
    known[known] = table.keys[at[known]] == distinct[known]
    if not known.all():
        if len(table.keys) + (~known).sum() > CACHE:
            table.__init__()
            known[:] = False
        new = first[~known]
        pieces = [raw[s:e].decode() for s, e in zip(start[new].tolist(), end[new].tolist(), strict=True)]
        table.add(distinct[~known], encode_pieces(pieces, path))
        at = np.searchsorted(table.keys, distinct)
    count = table.count[at][which]
    ids = table.ids[gather(table.start[at][which], count)].astype(np.uint32)
    row = np.bincount(rows_of(start, offsets), weights=count, minlength=n).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(row)])


def with_end_ids(ids: np.ndarray, offsets: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each row."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))


def row_ids(ids: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield ids[a:b]
