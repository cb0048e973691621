"""Source divergence, token files and token alignment against brute force, on small tables with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.llm import source_divergence, token_align, token_files
from pagetables.llm.queries import QUERIES
from pagetables.shipping import ship
from test_operators import LONG, ODD, docs_of, words  # noqa: F401

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id bigint, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- source divergence


def divergence(rows, least, add=5, top=50):
    """The audit over (text, lang, source) rows, by its definition."""
    rows = [tuple(x or "" for x in r) for r in rows]
    df, counts, groups = Counter(), Counter(), {(lang, s) for _, lang, s in rows}
    for text, lang, s in rows:
        found = TERM.findall(text.translate(LOW))
        df.update((lang, t) for t in set(found))
        counts.update((lang, s, t) for t in found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in df.items() if of == lang and n >= least]
        mine = sorted(s for of, s in groups if of == lang)

        def share(n, total, v=len(kept)):
            return 1 + 1_000_000_000 * (n + add) // (total + add * v)

        sizes = {s: sum(counts[lang, s, t] for t in kept) for s in mine}
        p = {s: {t: share(counts[lang, s, t], sizes[s]) for t in kept} for s in mine}
        q = {t: share(sum(counts[lang, s, t] for s in mine), sum(sizes.values())) for t in kept}
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in mine if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s, t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)}
    return out


def source_rows(n=400, seed=3):
    rng = random.Random(seed)
    vocabulary = {lang: [f"{lang}{chr(97 + i % 26)}{'é' * (i % 3)}" for i in range(60)] for lang in ("de", "en")}
    rows = []
    for i in range(n):
        lang = rng.choice(["de", "en"])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "ü", "Z", "", None])
        some = vocabulary[lang][: 20 if source == "a" else 60]
        rows.append((i, " ".join(rng.choices(some, k=rng.randint(0, 40))).title() + rng.choice(["", " 12!", "-x"]), lang, source))
    rows += [(None, None, None, None), (5, "", "en", "empty"), (5, "only-here " * 3, "xx", "s"), (6, "DE " * 20_000, "de", "long"), (7, "a", "en", "a")]
    return rows + rows[:40]


@pytest.mark.parametrize(("columns", "per_tile"), [(2048, 256), (7, 3), (1, 1)])
def test_divergence_equals_its_definition(spark, columns, per_tile):
    rows = source_rows()
    docs = ship(spark).createDataFrame(rows, SHAPE).selectExpr("*", "1 as n", "'x' as term", "2 as gid", "'y' as value")
    found = source_divergence.audit(docs, min_docs=4, columns=columns, rows=per_tile).collect()
    assert len(found) == len({tuple(r) for r in found})
    assert {tuple(r) for r in found} == divergence([r[1:] for r in rows], 4)


def test_divergence_without_kept_terms_or_rows(spark):
    docs = ship(spark).createDataFrame([(1, "a b", "en", "s"), (2, None, "en", "t"), (3, "c", None, "u")], SHAPE)
    found = {tuple(r) for r in source_divergence.audit(docs).collect()}
    assert found == {("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)}
    assert source_divergence.audit(docs.limit(0)).collect() == []


def test_shares_of_huge_counts_are_exact(spark):
    n = 3_000_000_000_000
    got = spark.range(1).select(source_divergence.share(F.lit(n), F.lit(7 * n + 1), F.lit(11).cast("bigint"), 5).alias("p")).first()[0]
    assert got == 1 + 1_000_000_000 * (n + 5) // (7 * n + 1 + 55)


def test_tree_walk_equals_the_matrix():
    rng = np.random.default_rng(1)
    for _ in range(60):
        rows, columns = int(rng.integers(2, 20)), int(rng.integers(1, 40))
        cells = (rng.random((rows, columns)) < rng.random()) * rng.integers(1, 100, (rows, columns))
        unseen = rng.integers(0, 5, rows)
        i, j = np.nonzero(cells)
        tree = source_divergence.Quadtree(i, j, max(1, (max(rows, columns) - 1).bit_length()))
        whole = np.where(cells > 0, cells, unseen[:, None])
        for split in (0, int(rng.integers(1, rows))):
            got, asked = source_divergence.walk(tree, cells[i, j][tree.order], unseen, split, rows, columns)
            want = np.abs(whole[:, None] - whole[None]).sum(2)
            assert (got[asked] == want[asked]).all()


# -- token files


def library_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, token_files.END_ID] for t in texts]


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 32])
def test_bits_round_trip(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 7, 8, 4095):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        data = token_files.pack(ids, width)
        assert len(data) == -(-n * width // 8)
        assert (token_files.unpack(data, width, n) == ids).all()


def test_width_is_the_least():
    assert [token_files.width_of(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


@pytest.mark.parametrize("width", [11, 16])
def test_any_run_of_a_shard_is_read(tmp_path, width):
    ids = np.random.default_rng(0).integers(0, 1 << width, 5003).astype("<u2")
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([5000, 3]), pa.array([ids[:5000].tobytes(), ids[5000:].tobytes()])], ["i", "n", "d"])
    n, docs, name, _ = token_files.write_shard(iter([batch]), str(tmp_path), "s", width, 97, 2)
    system, base = token_files.file_system(str(tmp_path))
    shard = token_files.Shard(system, f"{base}/{name}")
    assert (n, docs, shard.n, shard.n_docs, shard.width) == (5003, 2, 5003, 2, width)
    for a, b in ((0, 5003), (0, 0), (96, 98), (97, 194), (5002, 5003), (1, 4999)):
        assert (shard.ids(a, b) == ids[a:b]).all()
    (tmp_path / "other").write_bytes(b"x" * 64)
    with pytest.raises(ValueError):
        token_files.Shard(system, f"{base}/other")


def test_pieces_are_encoded_like_whole_texts():
    rng = random.Random(1)
    some = [*"abcABZ'stdlm019.,!?<>|-_ \n\t\r\x0b\x0c\x00\x1c\x1f\x7f", "é", "É", "ß", "×", "÷", "Σ", "漢", "…", "½", "İ", "don't", "I'LL"]
    some += [chr(c) for c in (0x301, 0x331, 0xA0, 0x3000, 0x200D, 0x345, 0x212A, 0x1D4B3)] + ["<|endoftext|>", "<|STARTOFTEXT|>"]
    code = token_files.Encoder(token_files.default_path())
    assert code.by_piece
    for k in range(40):
        texts = ["".join(rng.choices(some[: len(some) - 2 * (k % 2)], k=rng.randint(0, 40))) for _ in range(50)]
        ids, bounds = code.encode(pa.array(texts), token_files.END_ID)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == library_ids(texts)


def test_frequent_words_stay_remembered_when_the_memory_is_full(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 100)
    code = token_files.Encoder(token_files.default_path())
    learn, learned = code.learn, Counter()
    code.learn = lambda words, pure: learned.update(words) or learn(words, pure)
    letters = np.random.default_rng(4).integers(97, 123, (20, 30, 6), np.uint8)
    for part in letters:  # 30 new words in each, and two that all have
        texts = ["always here " + " ".join(w.tobytes().decode() for w in part), "", "here"]
        ids, bounds = code.encode(pa.array(texts), token_files.END_ID)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == library_ids(texts)
        assert len(code.known) <= 100 + 32
    assert learned["always"] == learned["here"] == 1


def test_other_files_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    code = token_files.Encoder(path)
    assert not code.by_piece
    texts = ["Two words,  and more\n", "", "é 漢"]
    ids, bounds = code.encode(pa.array(texts), 7)
    want = [[*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want


def test_token_files_of_odd_rows(spark, docs_of, tmp_path):  # noqa: F811
    rows = [*ODD, *[(20, f"same id {i}") for i in range(30)], (None, None), (-3, "first of all")]
    docs = docs_of(rows).selectExpr("*", "1 as _n", "'x' as start")
    folder = str(tmp_path / "files")
    token_files.write(docs, folder, token_files.default_path(), block=64, shard=500)
    got = token_files.read(spark, folder).collect()
    sums = {(r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_checksums(spark, folder).collect()}
    ids = library_ids([t for _, t in rows])
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), x) for (i, _), x in zip(rows, ids))
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.doc_id for r in got] == sorted([i for i, _ in rows if i is not None]) + [None, None]
    assert sums == {(r.start, r.doc_id, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got}
    assert spark.read.parquet(f"{folder}/manifest").count() > 3


def test_token_files_of_string_ids_and_of_no_row(spark, tmp_path):
    ship(spark)
    docs = spark.createDataFrame([("b", "two"), ("a", "one")], "name string, body string")
    for n, rows in ((2, ["a", "b"]), (0, [])):
        folder = str(tmp_path / str(n))
        token_files.write(docs.limit(n), folder, token_files.default_path(), id_col="name", text_col="body")
        assert [r.name for r in token_files.read(spark, folder, "name").orderBy("start").collect()] == rows


def test_token_files_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    ids = library_ids([d.text for d in docs])
    start = np.cumsum([0] + [len(x) for x in ids])
    want = {(d.doc_id, int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, s, x in zip(docs, start, ids)}
    assert {tuple(r) for r in QUERIES["op12_token_files"](ship(spark), SF).collect()} == want


# -- token alignment


def alignment(texts):
    """Numbers, groups and links of every text by the definition, counts over all texts."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    side_a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    side_a.encode_special_tokens = True
    side_b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes, spelled = token_align.ByteLevel(public_tokenizers.path("byte_bpe_50k.json")).bytes_of, side_b.id_to_piece

    def piece(i):
        return bytes([int(spelled(i)[3:5], 16)]) if side_b.is_byte(i) else spelled(i).replace("▁", " ").encode()

    found = []
    for text in texts:
        a, b = (side_a.encode(" " + text, add_special_tokens=False).ids, side_b.encode(text)) if text else ([], [])
        raw_a, raw_b = [a_bytes[i] for i in a], [piece(i) for i in b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            found.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_i, to_j = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:to_i], b[j:to_j]))
            i, j = to_i, to_j
        found.append((len(a), len(b), groups))
    counts, best = Counter(), defaultdict(int)
    for f in filter(None, found):
        counts.update({(x, y) for a, b in f[2] for x in a for y in b})
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [counts[x, y] for a, b in f[2] for x in a for y in b]
        tops = sum(counts[x, y] == best[x] for a, b in f[2] for x in a for y in b)
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[2])
        out.append((f[0], f[1], len(f[2]), len(links), tops, sum(links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def odd_texts(n, seed):
    rng = random.Random(seed)
    some = [*"abcABZ'st019.,!?<>|-_ \n\t\r\x0b\x0c\x00\x1c\x7f", "é", "ß", "漢", "…", "½", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁"]
    some += [chr(c) for c in (0x301, 0xA0, 0x3000, 0x2028, 0x200D, 0x1D4B3)] + [" ", " ", "  ", " the", " foo", "=======", "aaaa", "don't"]
    return ["".join(rng.choices(some[: len(some) if i % 2 else -16], k=rng.randint(0, 40))) for i in range(n)]


@pytest.mark.parametrize("heavy", [token_align.HEAVY, 3])
def test_alignment_equals_its_definition(docs_of, heavy):  # noqa: F811
    texts = [t for _, t in ODD if t is not LONG] + [LONG[:20_000], "trailing  ", "next", "=" * 5001, " " * 300] + odd_texts(150, 5)
    rows = [(None if i % 7 == 3 else i // 2, t) for i, t in enumerate(texts)]
    docs = docs_of(rows).selectExpr("*", "1 as _pair", "'x' as n_a")
    got = token_align.link_counts(docs, *token_align.default_paths(), heavy=heavy).collect()
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    want = Counter((i, *w) for (i, _), w in zip(rows, alignment(texts)))
    assert Counter((r.doc_id, *(r[c] for c in columns)) for r in got) == want


def test_alignment_of_no_row(docs_of):  # noqa: F811
    assert token_align.link_counts(docs_of([(1, "x")]).limit(0), *token_align.default_paths()).collect() == []


def test_overlaps_cover_both_sides(docs_of):  # noqa: F811
    texts = ["Überraschung für 12345 Leute", None, words(50)] + odd_texts(20, 6)
    a, b = token_align.sides(*token_align.default_paths())
    for r in token_align.align(docs_of(list(enumerate(texts))), *token_align.default_paths()).collect():
        ends_a = np.cumsum([len(a.bytes_of[i]) for i in r.a_ids]).tolist()
        ends_b = np.cumsum([len(b.bytes_of[i]) for i in r.b_ids]).tolist()
        at_a, at_b = [(e - len(a.bytes_of[i]), e) for i, e in zip(r.a_ids, ends_a)], [(e - len(b.bytes_of[i]), e) for i, e in zip(r.b_ids, ends_b)]
        want = [(i, j) for i, x in enumerate(at_a) for j, y in enumerate(at_b) if max(x[0], y[0]) < min(x[1], y[1])]
        assert list(zip(r.overlaps_a, r.overlaps_b)) == want
        shared = sorted(set(ends_a) & set(ends_b))
        assert r.a_groups == np.searchsorted(shared, ends_a).tolist() and r.b_groups == np.searchsorted(shared, ends_b).tolist()
