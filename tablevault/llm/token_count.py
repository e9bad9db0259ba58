"""Token counts of whole texts by overlap resynchronisation.

A text longer than a chunk is cut into chunks that overlap, each encoded with offsets on
its own. Two neighbours are spliced at a boundary where both start a token at the same
character and which is proven to be stable: there the tokenizer's own file says that no token
reaches across and that neither side depends on the other (``stable_at``). Tokens of the one
chunk before it and of the other from it on are counted. If an overlap holds no such
boundary it is widened, back to the start of its chunk, and then the chunk itself. That holds for
every text longer than a chunk and for ``.json`` and ``.model`` files alike; only tokenizers
whose file does not prove a boundary encode whole texts.

Within a chunk, a tokenizer that drops white space encodes each distinct unit between
blanks, or each distinct piece of it where the file proves the cut, once and reuses its ids while
they are kept; bytes are compared before ids are.

Null and empty texts have 0 tokens; repeated rows are counted each; columns
besides the id and the text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import LOWER, flat_text, map_arrow, slices, span_hashes, spans_equal, word_spans

CHUNK_CHARS = 4096
OVERLAP_CHARS = 256
KNOWN_UNITS = 500_000  # distinct units or their pieces whose ids a process keeps
TOGETHER = 1 << 13  # plain pieces that are encoded as one text

_LOADED: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a ``.json`` (tokenizers) or ``.model`` (sentencepiece)
    file, once per Python process."""
    if path not in _LOADED:
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            _LOADED[path] = tok
        else:
            import sentencepiece

            _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


# The normalizer and the split pattern for which ``Encoder`` may cut plain
# units itself. A plain unit holds Latin letters without and with marks, ASCII digits, and
# ASCII marks that begin no contraction; ``<`` and ``|`` are left to the special tokens.
_LOWER_STEPS = ["NFC", "Replace", "Lowercase"]
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF!-&(-/:;=>?@\[-`{}~]*")
_OTHER, _BLANK, _LETTER, _MARK, _DIGIT = range(5)
_KIND = np.array([_BLANK if c in " \n" else _OTHER if c > "~" or not _PLAIN.fullmatch(c) else _LETTER if c.isalpha()
                  else _DIGIT if c.isdigit() else _MARK for c in map(chr, range(256))], np.uint8)
_TWO_BYTES = 0xC3  # leads the Latin letters with marks: U+00C0 to U+00FF but for two


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level pre-tokenizer writes for each byte: itself if it is
    printable in Latin-1, the next free one from 256 on otherwise."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def _spec(path: str) -> dict:
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def splits_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer's file says that no token crosses white space: its
    pre-tokenizer drops white space, so both sides are encoded apart. Only then
    are texts encoded by units or spliced; other tokenizers encode whole texts."""
    steps = spec.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    return any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") for s in steps) \
        and not any(any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"]
                    for t in spec.get("added_tokens", []))


def lowers_and_splits_words(spec: dict) -> bool:
    """Whether each run of letters, each digit and each run of marks of a plain unit is
    encoded as the model encodes the lower-cased run: the normalizer only lower-cases it,
    the pre-tokenizer cuts there and maps bytes to letters, and no special token stands
    inside a plain unit."""
    if any(_PLAIN.fullmatch(t["content"]) for t in spec.get("added_tokens", [])):
        return False
    steps = [s.get("type") for s in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == _LOWER_STEPS and spec["model"].get("type", "BPE") == "BPE" and [s.get("type") for s in pre] == ["Split", "ByteLevel"]
            and pre[0]["pattern"] == {"Regex": _WORD_SPLIT} and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"])


BLANK_BEFORE, BLANK_HERE = "a blank before", "one blank here"


def stable_at(path: str) -> str | None:
    """The kind of place at which a tokenizer provably starts a token that depends on
    nothing before it, and before which nothing depends on what follows; None if its file
    proves none.

    ``BLANK_BEFORE``: white space is dropped, so a token starts after it. ``BLANK_HERE``: a single
    space between two characters that are no white space begins a word: with a byte-level
    pre-tokenizer because its pattern takes the space to what follows and never
    goes on over one; in a sentencepiece model because no piece holds a space after
    another character."""
    if path.endswith(".model"):
        tok = load(path)
        pieces = (tok.id_to_piece(k) for k in range(tok.get_piece_size()))
        return None if any("\u2581" in p.lstrip("\u2581") for p in pieces) else BLANK_HERE
    spec = _spec(path)
    if splits_at_blanks(spec):
        return BLANK_BEFORE
    steps = spec.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    plain = not spec.get("normalizer") and not any(
        any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
    byte_level = len(steps) == 1 and steps[0].get("type") == "ByteLevel" and steps[0].get("use_regex", True)
    return BLANK_HERE if plain and byte_level else None


class Encoder:
    """Token ids of texts.

    A text is the sequence of its units between spaces and line feeds. Where the
    tokenizer's file allows it, plain units are cut further, into lower-cased runs of
    letters, digits and runs of marks. Distinct pieces, told apart by their bytes, are encoded
    once while they are kept, in all tasks of a Python process; texts are then put
    together from their ids. Tokenizers that join over blanks encode whole texts."""

    _all: dict[str, Encoder] = {}  # by tokenizer file, for the life of the process

    def __init__(self, path: str):
        spec = _spec(path)
        self.tok, self.cut, self.plain = load(path), splits_at_blanks(spec), None
        if self.cut and lowers_and_splits_words(spec):
            from tokenizers import Tokenizer

            self.plain = Tokenizer(self.tok.model)
            self.plain.add_special_tokens(["\n"])  # no piece holds one, so its id stands between pieces
            self.line, self.letters = self.plain.token_to_id("\n"), _byte_letters() | {10: "\n"}
        self._forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._all:
            cls._all[path] = cls(path)
        return cls._all[path]

    def _forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def _bytes(tok, texts: list[str]) -> list[bytes]:
        if hasattr(tok, "encode_batch_fast"):
            return [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        return [array("I", ids).tobytes() for ids in tok.encode(texts, num_threads=1)]

    def _of_plain(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain pieces, and the number of each: many are encoded as one text, a line each."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(new), TOGETHER):
            part = new[lo:lo + TOGETHER]
            raw = b"\n".join(part)
            text = raw.decode() if raw.isascii() else raw.decode("latin-1").translate(self.letters)
            coded = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            lines = coded == self.line
            ids.append(coded[~lines])
            sizes.append(np.diff(np.flatnonzero(lines), prepend=-1, append=len(coded)) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def _of_whole(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are encoded as they stand, and the number of each."""
        coded = self._bytes(self.tok, [u.decode() for u in new])
        return np.frombuffer(b"".join(coded), "<u4"), np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """Where each unit of the texts begins, as a byte of its text; its text; its first piece; the
        slot of each piece; its number of ids."""
        data, offsets = flat_text(texts)
        begin, end, rows = word_spans((data != 32) & (data != 10), offsets)
        if not len(begin):
            return (np.zeros(0, np.int64),) * 5
        at, first, lo, hi = begin - offsets[rows], np.arange(len(begin)), begin, end
        whole = np.ones(len(begin), bool)
        if self.plain is not None:
            data, first, lo, hi, whole = plain_pieces(data, begin, end)
        code, place = distinct_spans(data, lo, hi)
        if len(self.slots) > KNOWN_UNITS:
            self._forget()
        raw = data.tobytes()
        found = list(map(raw.__getitem__, map(slice, lo[place].tolist(), hi[place].tolist())))
        slot = np.fromiter(map(self.slots.get, found, repeat(-1)), np.int64, len(found))
        for apart, coded in ((False, self._of_plain), (True, self._of_whole)):
            fresh = np.flatnonzero((slot < 0) & (whole[place] == apart))
            if len(fresh):
                new = [found[k] for k in fresh.tolist()]
                ids, sizes = coded(new)
                slot[fresh] = np.arange(len(self.slots), len(self.slots) + len(new))
                self.slots.update(zip(new, slot[fresh].tolist()))
                self.ids = np.concatenate([self.ids, ids])
                self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        slot = slot[code]
        return at, rows, first, slot, self.starts[slot + 1] - self.starts[slot]

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each unit of the texts begins, as a byte of its text; its text; its number of ids."""
        at, rows, first, _, size = self._pieces(texts)
        return at, rows, np.add.reduceat(size, first) if len(first) else size

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each; null is empty."""
        if not self.cut:
            coded = self._bytes(self.tok, pc.fill_null(texts, "").to_pylist())
            return np.frombuffer(b"".join(coded), "<u4"), np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
        _, rows, first, slot, size = self._pieces(texts)
        if not len(rows):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = np.cumsum(size)
        ids = self.ids[np.repeat(self.starts[slot] - (ends - size), size) + np.arange(ends[-1])]
        counts = np.bincount(rows, np.add.reduceat(size, first), minlength=len(texts)).astype(np.int64)
        return ids, counts


def plain_pieces(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bytes with plain units lower-cased; the first piece of each unit; start and end of
    every piece, which is a run of letters, a digit or a run of marks of a plain unit or any other unit
    as a whole; whether it is such a whole."""
    kind, low = _KIND[data], LOWER[data]
    lead = np.flatnonzero(data[:-1] == _TWO_BYTES)
    after = data[lead + 1]
    lead, after = (x[(after != 0x97) & (after != 0xB7)] for x in (lead, after))  # signs of arithmetic
    kind[lead] = kind[lead + 1] = _LETTER
    low[lead + 1] = np.where(after < 0x9F, after | 0x20, after)  # U+00DF has no capital here
    starts = np.empty(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts |= kind == _DIGIT
    starts &= kind != _BLANK
    odd = np.unique(np.searchsorted(begin, np.flatnonzero(kind == _OTHER), side="right") - 1)
    whole = np.zeros(len(data), bool)
    if len(odd):
        edges = np.zeros(len(data) + 1, np.int8)
        edges[begin[odd]] += 1
        edges[end[odd]] -= 1
        whole = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        starts &= ~whole
        low = np.where(whole, data, low)
    starts[begin] = True
    lo = np.flatnonzero(starts)
    first = np.searchsorted(lo, begin)
    hi = np.append(lo[1:], end[-1])
    hi[first[1:] - 1] = end[:-1]
    return low, first, lo, hi, whole[lo]


def distinct_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span, equal for equal bytes, and where each number stands first. Hashes find
    candidates, bytes decide."""
    code, distinct = pd.factorize(span_hashes(data, begin, end))
    first = np.empty(len(distinct), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    of = first[code]
    size = end - begin
    if not ((size == size[of]) & spans_equal(data, begin, begin[of], np.minimum(size, size[of]))).all():
        raw, seen = data.tobytes(), {}
        code = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(begin.tolist(), end.tolist())], np.int64)
        first = np.empty(len(seen), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return code, first


def chunk_spans(text: bytes, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Overlapping chunks of a UTF-8 text, cut between characters."""
    spans, lo = [], 0
    while True:
        hi = min(len(text), lo + chunk)
        while hi < len(text) and text[hi] & 0xC0 == 0x80:
            hi -= 1
        spans.append((lo, hi))
        if hi == len(text):
            return spans
        lo = max(lo + 1, hi - overlap)
        while text[lo] & 0xC0 == 0x80:
            lo += 1


def counts_by_units(encode: Encoder, texts: list[bytes], chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Tokens and chunks of texts of a tokenizer that drops white space: the chunks of all texts are
    encoded together, with the offsets of their units, and spliced one after the other. A
    text in which an overlap has no boundary goes to ``chunked_count``, which widens it."""
    spans = [chunk_spans(t, chunk, overlap) for t in texts]
    pieces = pa.array([t[lo:hi] for t, of in zip(texts, spans) for lo, hi in of], pa.binary()).cast(pa.string())
    at, rows, size = encode.units(pieces)
    edges = np.searchsorted(rows, np.arange(len(pieces) + 1))
    total = np.concatenate([[0], np.cumsum(size)])
    out, k = [], 0
    for text, of in zip(texts, spans):
        tokens, begin = 0, edges[k]  # the first unit that is still to be counted
        for n, (lo, hi) in enumerate(of):
            last, after = edges[k + n + 1], None
            if n + 1 < len(of):
                here = at[begin:last] + lo
                there = of[n + 1][0]
                # units that start behind the overlap's first byte have their blank inside it
                if not len(here) or here[-1] <= there:
                    tokens = None
                    break
                p = here[-1]  # the chunk's end may cut this unit, and cannot move its start
                after = edges[k + n + 1] + int(np.searchsorted(at[edges[k + n + 1]:edges[k + n + 2]], p - there))
                last -= 1
            tokens += int(total[last] - total[begin])
            begin = after
        if tokens is None:
            out.append(chunked_count(encode.tok, text.decode(), BLANK_BEFORE, chunk, overlap))
        else:
            out.append((tokens, len(of)))
        k += len(of)
    return out


def chunked_count(tok, text: str, stable: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[int, int]:
    """Tokens of a text, encoded in overlapping chunks of ``chunk`` characters, and the number of chunks."""
    total, at, n, begin, chunks = 0, 0, len(text), 0, 1  # tokens that start before ``at`` are counted
    end = min(n, chunk)
    here = _starts(tok, text, 0, end)
    while end < n:
        width = overlap
        while True:
            low = max(begin, end - width)
            high = min(n, max(low + chunk, end + overlap))
            there = _starts(tok, text, low, high)
            splice = _common(text, here, there, low, end, stable)
            if splice is not None and splice > at:
                break
            if low <= begin:  # no boundary in the whole chunk: make it longer
                end = min(n, begin + 2 * (end - begin))
                here = _starts(tok, text, begin, end)
                if end == n:
                    return total + int((here >= at).sum()), chunks
                width = overlap
            else:
                width *= 2
        total += int(((here >= at) & (here < splice)).sum())
        at, begin, end, here, chunks = splice, low, high, there, chunks + 1
    return total + int((here >= at).sum()), chunks


def _starts(tok, text: str, lo: int, hi: int) -> np.ndarray:
    """Where the tokens of a stretch start, as characters of the text."""
    part = text[lo:hi]
    if hasattr(tok, "encode_batch_fast"):
        return np.array([a for a, _ in tok.encode(part, add_special_tokens=False).offsets], np.int64) + lo
    # sentencepiece counts bytes
    raw = np.frombuffer(part.encode() + b"\0", np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    return character[np.array([p.begin for p in tok.encode(part, return_type="proto").pieces], np.int64)] + lo


def _common(text: str, here: np.ndarray, there: np.ndarray, low: int, end: int, stable: str) -> int | None:
    """The last stable place inside ``low`` and ``end`` at which both encodings start a token."""
    for p in np.intersect1d(here, there)[::-1].tolist():
        if not low < p < end - 1:
            continue
        if stable == BLANK_BEFORE and text[p - 1] in " \n":
            return p
        # some libraries give a word's offset with its blank, some without
        blank = p if text[p] == " " else p - 1
        if stable == BLANK_HERE and low < blank and text[blank] == " " and not text[blank - 1].isspace() and not text[blank + 1].isspace():
            return p
    return None


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``(id, n_bytes, n_tokens, n_chunks)`` of every row; ``tokenizer`` is a file path
    that every executor can open (an installed package's data file). ``n_chunks`` is the number
    of chunks a text was spliced from, 1 for a text that is no longer than one."""
    spec = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, stable = Encoder.of(tokenizer), stable_at(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pc.fill_null(part.column("text"), "")
                size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
                long = size > chunk_chars if stable else np.zeros(len(size), bool)
                counts, chunks = encode(pc.if_else(pa.array(long), "", texts))[1], np.ones(len(size), np.int64)
                places = np.flatnonzero(long)
                if stable == BLANK_BEFORE:
                    found = counts_by_units(encode, texts.take(pa.array(places)).cast(pa.binary()).to_pylist(), chunk_chars, overlap_chars)
                else:
                    found = [chunked_count(encode.tok, texts[k].as_py(), stable, chunk_chars, overlap_chars) for k in places.tolist()]
                for k, (n, of) in zip(places.tolist(), found):
                    counts[k], chunks[k] = n, of
                yield pa.record_batch([part.column("id"), pa.array(size), pa.array(counts), pa.array(chunks)],
                                      names=["id", "n_bytes", "n_tokens", "n_chunks"])

    out = map_arrow(spec, count, f"id {spec.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, n_chunks long")
    return out.withColumnRenamed("id", id_col)


__all__ = ["Encoder", "chunked_count", "count_tokens", "load", "splits_at_blanks", "stable_at"]
