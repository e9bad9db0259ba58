"""op2 and op7 against the library."""

import random
import zlib

import numpy as np
import pytest

from tablevault.llm import rans, token_count, token_output
from tablevault.llm.queries import tokenizer_file
from tablevault.session import new_work_dir
from tests.llm.helpers import docs_of, prose, rows, with_clashes

MIXED = "aZé'sß .,!?;:\n\t \x1c1٣İΣ\u0301`-_()日本 "


def odd_texts():
    rng = random.Random(3)
    scraps = ["".join(rng.choice(MIXED) for _ in range(rng.randrange(80))) for _ in range(60)]
    return [None, "", "  \n ", "it's DON'T <|endoftext|>x a<|startoftext|> b", "word.,;:!? !!word. end..", prose(1, 20_000),
            "x" * 5000 + " y " + "z" * 3000, "é" * 9000, *scraps]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def ids_of(texts):
    return [np.array(e.ids, "<u4") for e in library().encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def test_token_counts_equal_the_library(spark):
    texts = odd_texts()
    want = [(k, len((t or "").encode()), len(i)) for k, (t, i) in enumerate(zip(texts, ids_of(texts)))]
    docs = with_clashes(docs_of(spark, texts))
    for chunk, overlap in ((token_count.CHUNK_CHARS, token_count.OVERLAP_CHARS), (300, 40), (40, 10)):
        got = token_count.count_tokens(docs, tokenizer_file(), chunk_chars=chunk, overlap_chars=overlap)
        assert rows(got, "doc_id", "n_bytes", "n_tokens") == sorted(want, key=str)
    assert token_count.count_tokens(docs_of(spark, []), tokenizer_file()).count() == 0


def test_new_units_are_cut_into_pieces_that_are_looked_up_once():
    letters, rng = "abcdeéÀÑßz", random.Random(7)
    stems = ["".join(rng.choice(letters) for _ in range(8)) for _ in range(50)]
    texts = [" ".join(rng.choice((s, s.upper(), s.title())) + f"{rng.choice('.,!?')}{k}-{s}" for s in stems) for k in range(40)]
    # other kinds of bytes beside plain ones, signs between the letters, a special token inside a unit
    texts += ["aÀ×b÷ÿ", "\x01a.1 b\x7f", "İzmir", "٣1a", "don't.stop 日本a1", "a.<|endoftext|>B2", "Ÿé e\u0301", "\t", *odd_texts()]
    encode = token_count.Encoder(tokenizer_file())
    ids, counts = encode(token_count.pa.array(texts[:40]))
    assert len(encode.slots) < 2 * len(stems)  # not one for each of 2000 units
    for part in (texts, texts[40:], [None]):
        ids, counts = encode(token_count.pa.array(part, "string"))
        want = ids_of(part)
        assert counts.tolist() == [*map(len, want)] and ids.tolist() == np.concatenate(want).tolist()
        sizes = encode.units(token_count.pa.array(part, "string"))
        assert np.bincount(sizes[1], sizes[2], len(part)).tolist() == counts.tolist()


FILES = ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model")


def whole(tok, text):
    return len(tok.encode(text, add_special_tokens=False).ids if hasattr(tok, "encode_batch_fast") else tok.encode(text))


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("chunk,overlap", [(200, 10), (1000, 64), (4096, 256)])
def test_chunks_are_spliced_where_both_agree(name, chunk, overlap):
    import public_tokenizers

    path, rng = public_tokenizers.path(name), random.Random(1)
    tok, stable = token_count.load(path), token_count.stable_at(path)
    big = "".join(rng.choice(MIXED + "     abcdef") for _ in range(20_000))
    for text in (big, prose(2, 3000), "x" * 3000, "a b " * 2000, "", " ", " " * 5000, "日本語" * 900, "<|endoftext|> it's " * 300):
        assert token_count.chunked_count(tok, text, stable, chunk, overlap)[0] == whole(tok, text)
        if stable == token_count.BLANK_BEFORE:
            encode = token_count.Encoder.of(path)
            assert token_count.counts_by_units(encode, [text.encode()], chunk, overlap)[0][0] == whole(tok, text)


@pytest.mark.parametrize("name", FILES)
def test_every_text_longer_than_a_chunk_is_spliced(spark, name):
    import public_tokenizers

    path = public_tokenizers.path(name)
    tok = token_count.load(path)
    texts = [None, "", "a  b\nc", prose(1, 50), prose(2, 1500), prose(3, 30_000), ("é😀 it's\n" + prose(4, 20)) * 900]
    assert max(len(t or "") for t in texts) > 100_000
    got = {r["doc_id"]: r for r in token_count.count_tokens(docs_of(spark, texts), path).collect()}
    for k, t in enumerate(texts):
        assert got[k]["n_tokens"] == whole(tok, t or "")
        n = len((t or "").encode())
        assert (got[k]["n_chunks"] > n // (token_count.CHUNK_CHARS + token_count.OVERLAP_CHARS) // 2 if n > 2 * token_count.CHUNK_CHARS
                else True) and (got[k]["n_chunks"] == 1 or n > token_count.CHUNK_CHARS)
    assert sum(r["n_chunks"] > 1 for r in got.values()) == 3


def test_tokenizers_that_prove_no_boundary_encode_whole_texts(tmp_path):
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}):
        path = str(tmp_path / f"{len(change)}{next(iter(change))}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump(spec | change, f)
        assert token_count.stable_at(path) is None


def test_rans_round_trips_and_decodes_from_checkpoints():
    rng = np.random.default_rng(1)
    for n in (1, 2047, 2048, 2049, 400_000):
        ids = (rng.zipf(1.4, n) % 49_408).astype(np.uint32)
        table = rans.Table.count(ids)
        assert table.freqs.sum() == 1 << rans.SCALE
        states, words, marks = rans.encode(ids, table)
        assert (rans.decode(n, table, states, words) == ids).all()
        assert len(marks) == (-(-n // rans.LANES) - 1) // rans.CHECKPOINT_STEPS
        for m in marks:
            assert (rans.decode(n, table, m[2:], words, int(m[0]), int(m[1])) == ids[int(m[0]) * rans.LANES:]).all()
    same = np.zeros(5000, np.uint32)  # one symbol costs nothing
    assert len(rans.encode(same, rans.Table.count(same))[1]) == 0


def test_token_files_hold_every_document_in_order(spark):
    texts = [*odd_texts(), "same id, first", "same id, second"]
    keys = [3 * k for k in range(len(texts) - 2)] + [30, 30]
    order = sorted(range(len(texts)), key=lambda k: (keys[k], texts[k] or ""))
    want, at = [], 0
    for k, ids in zip(order, ids_of([texts[k] for k in order])):
        ids = np.append(ids, 2).astype("<u4")
        want.append((keys[k], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = token_output.tokens_written_and_read(with_clashes(docs_of(spark, texts, ids=keys)), tokenizer_file())
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(want)
    assert token_output.tokens_written_and_read(docs_of(spark, []), tokenizer_file()).count() == 0


def test_token_files_give_back_ids_and_notice_damage(spark):
    texts = [prose(s, 300) for s in range(20)]
    target = new_work_dir(spark, "tokens")
    manifest = token_output.write_tokens(docs_of(spark, texts), target, tokenizer_file())
    got = {r["id"]: r["ids"] for r in token_output.read_tokens(manifest).collect()}
    assert got == {k: [*map(int, ids), 2] for k, ids in enumerate(ids_of(texts))}
    row = manifest.first().asDict()
    with open(row["path"].removeprefix("file:"), "r+b") as f:
        f.seek(row["offset"] + row["length"] // 2)
        byte = f.read(1)
        f.seek(-1, 1)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(ValueError, match="damaged"):
        token_output.read_block(row)
