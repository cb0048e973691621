"""The operators against brute force, on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.llm import (
    bpe,
    exact_dedup,
    html_extract,
    jaccard_join,
    language_id,
    lm_scoring,
    mixing,
    pu_quality,
    pu_toxicity,
    quality_rules,
)
from pagetables.llm.common import n_words, remainder
from pagetables.llm.queries import QUERIES, held_out
from pagetables.shipping import ship

SHAPE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SMALL_DIR = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RNG = random.Random(7)
VOCABULARY = ["".join(RNG.choices("abcdefghiklmnoprstuvé", k=RNG.randint(2, 8))) for _ in range(400)]


def words(n, rng=RNG):
    return " ".join(rng.choices(VOCABULARY, k=n))


LONG = words(30_000)
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "A  b\tc"), (5, "A  b\tc"), (6, LONG), (None, "no id at all here"),
    (7, "x" * 5000), (8, "line one\nline one\nline two\n\n\nline one"), (9, "é漢字 <|endoftext|>   ½ 𝒳"), (10, "\x00 a\x1fb"),
]


@pytest.fixture(scope="module")
def docs_of(spark):
    """``docs_of([(id, text), ...])``: a small documents table with columns whose names might clash."""
    ship(spark)

    def make(rows, lang="en", source="s"):
        df = spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in rows], SHAPE)
        for name in ("keep_id", "score", "size", "_id", "_text", "_class", "n", "kept"):
            df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_base_rules(docs_of):
    got = {(r["doc_id"], r["n_words"]): r for r in rows_of(quality_rules.judge(docs_of(ODD + [(11, words(6) * 9)])))}
    for i, t in ODD:
        w = WORD.findall(t or "")
        seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        again = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i, len(w)]
        assert r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == sum((t or "").count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == len(again)
        assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def padded(text):
    return "   " + re.sub(r"[\x20\x09-\x0D]+", " ", text)


def kneser_ney_bits(texts):
    """Bits per character of every text under the interpolated modified Kneser-Ney model of all, by its definition."""
    counts = {4: Counter()}
    for t in texts:
        counts[4].update(padded(t)[i - 3 : i + 1] for i in range(3, len(padded(t))))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def off(k, n):
        have = [max(1, sum(v == j for v in counts[k].values())) for j in (1, 2, 3, 4)]
        y, j = have[0] / (have[0] + 2 * have[1]), min(n, 3)
        return min(max(j - (j + 1) * y * have[j] / have[j - 1], 0.05 * j), 0.95 * j)

    offs = {k: {n: off(k, n) for n in set(counts[k].values())} for k in counts}
    totals, left = Counter(), Counter()
    for k in counts:
        for g, n in counts[k].items():
            totals[k, g[:-1]] += n
            left[k, g[:-1]] += offs[k][n]

    def p(g):
        out = 1 / (len(counts[1]) + 1)
        for k in (1, 2, 3, 4):
            own = g[4 - k :]
            if totals[k, own[:-1]]:
                n = counts[k][own]
                out = (n - offs[k].get(n, 0) if n else 0) / totals[k, own[:-1]] + left[k, own[:-1]] / totals[k, own[:-1]] * out
        return out

    return [sum(-math.log2(p(padded(t)[i - 3 : i + 1])) for i in range(3, len(padded(t)))) / max(1, len(padded(t)) - 3) for t in texts]


def test_perplexity_equals_its_definition(docs_of):
    texts = [words(30, random.Random(i)) for i in range(20)] + ["é漢 字\n\n𝒳  a", "", " ", "aaaa", "Ünder  the\tsea"]
    got = {r["doc_id"]: r for r in rows_of(quality_rules.judge(docs_of(list(enumerate(texts)))))}
    want = kneser_ney_bits(texts)
    assert [got[i]["bits"] for i in range(len(texts))] == pytest.approx(want, rel=1e-4)
    assert got[0]["perplexity"] == pytest.approx(2 ** want[0], rel=1e-3)


@pytest.mark.parametrize("most", [quality_rules.COMMON, 50, 0])
def test_rare_grams_have_their_part(docs_of, monkeypatch, most):
    """More characters than any array holds grams, and texts of grams that occur once."""
    monkeypatch.setattr(quality_rules, "COMMON", most)
    rng = random.Random(3)
    rare = ["".join(chr(rng.randint(0x4E00, 0x5E00)) for _ in range(n)) for n in (5, 60, 400)]
    texts = [" ".join(VOCABULARY[:20])] * 3000 + rare + ["", "zzq! " + rare[0]]
    got = rows_of(quality_rules.judge(docs_of([*enumerate(texts), (99, None), (4, rare[0])])))
    want = kneser_ney_bits([*texts, "", rare[0]])
    assert sorted(r["bits"] for r in got) == pytest.approx(sorted(want), rel=1e-5, abs=1e-5)


@pytest.mark.parametrize("kept", [quality_rules.KEPT, 50])
def test_shares_sum_to_one(docs_of, kept):
    rows = docs_of([(i, words(40, random.Random(i))) for i in range(30)]).selectExpr("doc_id as _id", "text as _text", "0 as _slot")
    model = quality_rules.learn(rows, kept)[0]
    assert all(len(order[0]) <= kept for order in model.orders)
    alphabet = sorted({ord(c) for w in VOCABULARY for c in w} | {32})
    for text in ("the", "a b", "zz z"[:3]):
        before = sum(ord(c) << quality_rules.POINT * (2 - i) for i, c in enumerate(text))
        shares = np.exp2(-model.bits(np.full(len(alphabet), before), np.array(alphabet)))
        seen = len(alphabet) / (len(alphabet) + 1)
        assert seen - 0.05 < shares.sum() <= 1 + 1e-6


def test_random_letters_of_any_script_are_rejected(docs_of):
    rng = random.Random(8)
    letters = "абвгдежзиклмнопрстуфхцчшщыэюя"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(150)]
    clean = [(i, " ".join(rng.choices(vocabulary, k=80))) for i in range(200)]
    junk = [(1000 + i, " ".join("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(80))) for i in range(40)]
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(docs_of(clean + junk, lang="ru")))}
    assert sum(kept[i] for i, _ in junk) <= 4
    assert sum(kept[i] for i, _ in clean) >= 198


def test_perplexity_rejects_noise(docs_of):
    clean = [(i, words(80, random.Random(i))) for i in range(60)]
    noise = [(100 + i, " ".join("".join(random.Random(i * 99 + k).choices("qxzjwy#%", k=6)) for k in range(80))) for i in range(3)]
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(docs_of(clean + noise)))}
    assert all(kept[i] for i, _ in clean)
    assert not any(kept[i] for i, _ in noise)


def test_perplexity_is_of_the_own_language(docs_of):
    rng = random.Random(2)
    tongues = [["".join(rng.choices("abcdefg", k=rng.randint(3, 7))) for _ in range(60)] for _ in range(2)]
    en, de = ([" ".join(rng.choices(tongue, k=80)) for _ in range(300)] for tongue in tongues)
    both = "\n".join(" ".join(rng.choices(tongues[k % 2], k=8)) for k in range(10))
    docs = docs_of([*enumerate(en), (1000, de[0]), (1001, both)]).unionByName(docs_of([(2000 + i, t) for i, t in enumerate(de)], lang="de"))
    kept = {r["doc_id"]: r["kept"] for r in rows_of(quality_rules.judge(docs))}
    assert not kept.pop(1000) and not kept.pop(1001)
    assert sum(kept.values()) > 0.98 * len(kept)


def test_every_language_has_its_own_band(docs_of):
    rng, docs = random.Random(4), None
    for i in range(20):
        tongue = ["".join(rng.choices("abcdefg", k=rng.randint(3, 7))) for _ in range(40)]
        some = docs_of([(100 * i + k, " ".join(rng.choices(tongue, k=60))) for k in range(20 - i // 2)], lang=f"l{i:02}")
        docs = some if docs is None else docs.unionByName(some)
    got = rows_of(quality_rules.judge(docs))
    assert Counter(r["doc_id"] // 100 for r in got) == {i: 20 - i // 2 for i in range(20)}
    # Texts of one length have the band of their language.
    by_language = {}
    for r in got:
        by_language.setdefault(r["doc_id"] // 100, []).append((r["band_low"] + 0.9 * (r["band_high"] - r["band_low"]) / 2))
    middles = [sum(v) / len(v) for v in by_language.values()]
    assert len({round(m, 3) for m in middles}) > 17


def test_lm_scoring_base_and_bits(spark, docs_of):
    rows = ODD + [(20 + i, words(60, random.Random(i))) for i in range(40)]
    got = rows_of(lm_scoring.score(docs_of(rows), ~held_out("doc_id", 7, 2)))
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in WORD.findall((t or "").translate(LOW)))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    want = Counter()
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        want[i, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, round(base, 4)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert len({round(r["score"], 9) for r in got if r["doc_id"] == 5}) == 1


def test_lm_scoring_reads_the_words_before(docs_of):
    follows = {w: VOCABULARY[(k * 7 + 1) % 400] for k, w in enumerate(VOCABULARY)}
    texts = {}
    for i in range(400):
        text = [VOCABULARY[i]]
        while len(text) < 40:
            text.append(follows[text[-1]])
        texts[i] = text
    shuffled = {1000 + i: random.Random(i).sample(t, len(t)) for i, t in texts.items()}
    rows = [(i, " ".join(t)) for i, t in (texts | shuffled).items()]
    got = {r["doc_id"]: r["score"] for r in rows_of(lm_scoring.score(docs_of(rows), (F.col("doc_id") < 1000) & (F.col("doc_id") % 4 != 0)))}
    # Held-out prose costs far less than its own words shuffled.
    assert all(got[i] > 0.5 * got[1000 + i] for i in range(0, 400, 4))


def test_lm_scoring_slots_are_whole():
    assert lm_scoring.OFFSETS[-1] == 2**16 + 2**18 + 2**19 + 2**22 + 2**20 + 2**21


def test_lm_scoring_mixes_by_hand(spark):
    """Bits by ``priced`` against the counts themselves, with the shares it may choose from."""
    rng = random.Random(5)
    seen = Counter((rng.randrange(3), rng.randrange(4), rng.randrange(5)) for _ in range(300))
    rows = [(100 * u + 10 * v + w, w, v, 10 * v + w, 10 * u + v, 100 * u + 10 * v + w, 8.0 + w, seen[u, v, w]) for u in range(3) for v in range(5) for w in range(5)]
    grams = spark.createDataFrame(rows, "_gram long, _w long, _v long, _vw long, _uv long, _uvw long, _cost double, _n long")
    got = {r["_gram"]: r["_cost"] for r in lm_scoring.priced(grams).collect()}

    def cost(at, shares):
        u, v, w = at
        p = 2.0 ** -(8.0 + w)
        for share, same in zip(shares, (lambda x: True, lambda x: x[1] == v, lambda x: x[:2] == (u, v)), strict=True):
            whole = sum(n for x, n in seen.items() if same(x))
            p = (1 - share) * p + share * sum(n for x, n in seen.items() if same(x) and x[2] == w) / whole if whole else p
        return -math.log2(p)

    first = {round(cost((0, 4, w), (s, 0, 0)), 9) for w in range(5) for s in lm_scoring.SHARES}
    assert all(round(got[40 + w], 9) in first for w in range(5))  # word 4 never comes before another
    for at in seen:
        some = [cost(at, (a, b, c)) for a in lm_scoring.SHARES for b in lm_scoring.SHARES for c in lm_scoring.SHARES]
        assert min(abs(x - got[100 * at[0] + 10 * at[1] + at[2]]) for x in some) < 1e-9


def test_jaccard_join_is_exact(docs_of):
    rng = random.Random(3)
    rows = list(ODD)
    for family in range(12):
        text = words(rng.choice([9, 14, 25, 60, 140, 400]), rng).split()
        for k in range(8):
            copy = list(text)
            for _ in range(rng.choice([0, 1, 1, 2, 3, max(1, len(text) // 40)])):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            rows.append((100 + family * 10 + k, " ".join(copy)))
    line = words(12, rng)
    rows += [(300 + i, f"{line} {words(rng.randint(1, 6), rng)}") for i in range(80)]
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append((i, frozenset(tuple(w[k : k + 4]) for k in range(max(len(w) - 3, 1))) if w else frozenset()))
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and group[x] != group[y]:
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    want = Counter()
    for x, (i, s) in enumerate(sets):
        ids = [sets[y][0] for y in range(len(rows)) if group[y] == group[x] and sets[y][0] is not None]
        want[i, len(s), min(ids) if s and ids else i] += 1
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(jaccard_join.join(docs_of(rows))))
    assert got == want


def test_jaccard_stage_is_brute_force_on_five_words(spark, docs_of):
    rng, rows = random.Random(11), []
    for family, length in enumerate((30, 100, 100, 400, 1000)):
        text = [rng.choice(VOCABULARY) for _ in range(length)]
        rows.append((family * 10, " ".join(text)))
        for k, share in enumerate((0.18, 0.21, 0.24, 0.3), 1):
            rows.append((family * 10 + k, " ".join(text + [rng.choice(VOCABULARY) for _ in range(round(share * length))])))
    spread = list(rows[-5][1].split())
    for at in range(20, 1000, 47):
        spread[at] = "replaced"
    rows.append((99, " ".join(spread)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    near = {(x, y) for x in sets for y in sets if x < y and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    least = {i: i for i in sets}
    for _ in sets:
        for x, y in near:
            least[x] = least[y] = min(least[x], least[y])
    stays = {i for i in sets if least[i] == i}
    assert {r["doc_id"] for r in rows_of(jaccard_join.stage(spark, docs_of(rows), ""))} == stays
    # Four words and 0.85 link fewer of them.
    assert {r["doc_id"] for r in rows_of(jaccard_join.join(docs_of(rows))) if r["doc_id"] == r["component_id"]} > stays


def test_shared_keys_of_hot_and_other_rows(docs_of):
    line = words(30)
    many = docs_of([(i, f"{line} {VOCABULARY[i]}") for i in range(60)]).coalesce(1)
    few = docs_of([(100 + i, f"{line} {VOCABULARY[100 + i]}") for i in range(3)]).coalesce(1)
    rows = many.unionByName(few).selectExpr("doc_id AS _id", "text AS _text")
    index = [(r["_key"], r["_class"], r["_hot"]) for r in jaccard_join.index_rows(rows, 85).collect()]
    by = {}
    for key, name, _ in index:
        by.setdefault(key, set()).add(name)
    assert any(hot > 0 for *_, hot in index) and max(map(len, by.values())) == 63
    got = [tuple(r) for r in jaccard_join.shared_keys(jaccard_join.index_rows(rows, 85)).select("_key", "_class").collect()]
    assert sorted(got) == sorted((key, name) for key, names in by.items() if len(names) > 1 for name in names)


def test_band_differences():
    for band in jaccard_join.bands(85, 3000):
        for a in {band.low, (band.low + band.high) // 2, band.high}:
            for b in range(a, min(band.reach, a * 100 // 85) + 1):
                both = -(-85 * (a + b) // 185)
                if both <= a:
                    assert a + b - 2 * both <= band.differ


@pytest.mark.parametrize("text", [LONG[:4000], "x" * 3000, "ab" * 500, " " * 200, "it's 12 ½ <|endoftext|>\n\n z", "漢字かな" * 60])
def test_bpe_equals_library(text):
    from tokenizers import Tokenizer

    code = bpe.codec(bpe.default_path())
    ids = code.encode(text)
    assert ids == Tokenizer.from_file(bpe.default_path()).encode(text, add_special_tokens=False).ids
    assert code.decode(ids) == text


def test_bpe_scan_equals_heap():
    code = bpe.codec(bpe.default_path())
    for w in ["".join(random.Random(i).choices("abcdeé ", k=40)) for i in range(200)]:
        ids = [code.byte_id[b] for b in w.encode()]
        assert code.scan(list(ids)) == code.heap(list(ids))


def test_bpe_rows(docs_of):
    got = rows_of(bpe.digest(bpe.encode(docs_of(ODD), bpe.default_path())))
    assert len(got) == len(ODD)
    one = next(r for r in got if r["doc_id"] == 1)
    assert one["n_tokens"] == 0 and one["ids_sha256"] == hashlib.sha256(b"").hexdigest() == one["decoded_sha256"]


def test_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        p = mixing.Permutation(n + 5, n)
        there = p(np.arange(n))
        assert sorted(there) == list(range(n))
        assert (p.inverse(there) == np.arange(n)).all()


def test_mixing(spark, docs_of):
    rng = random.Random(11)
    parts = [docs_of([(i * 10 + k, words(rng.randint(0, 3000), rng)) for k in range(9)], source=s) for i, s in enumerate(["a", "b", None, "c"])]
    docs = parts[0]
    for p in parts[1:] + [docs_of(ODD, source="b")]:
        docs = docs.unionByName(p)
    got = rows_of(mixing.taken(docs))
    assert len(got) == 36 + len(ODD)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        own = by.setdefault((r["source_size"], r["target"]), [0, 0])
        own[0] += r["size"]
        own[1] += r["taken"]
    assert all(size == own[0] and abs(own[1] - target) < 1 for (size, target), own in by.items())
    assert abs(sum(t for _, t in by) - sum(s for s, _ in by)) < 1e-6 * sum(s for s, _ in by)
    assert Counter(map(str, got)) == Counter(map(str, rows_of(mixing.taken(docs))))


def test_targets(spark):
    sizes = [("a", 10), ("b", 1000), ("c", 40), (None, 500), ("d", 0)]
    got = {r["source"]: r["target"] for r in rows_of(mixing.targets(spark.createDataFrame(sizes, "source string, source_size bigint")))}
    order = sorted((s for s, _ in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    cap, total = {s: 3 * n for s, n in sizes}, 1550
    full = set()
    while True:
        rest = [s for s in cap if s not in full]
        level = (total - sum(cap[s] for s in full)) / sum(weight[s] for s in rest)
        above = {s for s in rest if level * weight[s] > cap[s]}
        if not above:
            break
        full |= above
    assert got == pytest.approx({s: cap[s] if s in full else level * weight[s] for s in cap})


def test_exact_dedup(docs_of):
    rows = ODD + [(30, "same  text"), (31, "same\ttext"), (32, "same text "), (33, "Same text"), (30, "same  text")]
    got = rows_of(exact_dedup.exact_groups(docs_of(rows)))
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    assert len(got) == len(rows)
    for r in got:
        group = [i for (i, _), n in zip(rows, norm, strict=True) if hashlib.sha256(n.encode()).hexdigest() == r["text_sha256"]]
        ids = [i for i in group if i is not None]
        assert r["group_size"] == len(group) and r["keep_id"] == (min(ids) if ids else None)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(set(norm))


def test_exact_dedup_plan_is_native(docs_of):
    plan = exact_dedup.exact_groups(docs_of(ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def brute_phrases(text, sample):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_equal_brute_force():
    sample = words(300).encode()
    texts = [words(20).encode(), b"zzz qq", b"", words(90).encode(), b"\xff\xfe"]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = language_id.phrases(np.frombuffer(b"".join(texts), np.uint8), bounds, language_id.parser(sample))
    size = language_id.PIECE
    want = [sum(brute_phrases(t[i : i + size], sample) for i in range(0, len(t), size)) for t in texts]
    assert got.tolist() == want


def test_language(spark, docs_of):
    rows = [(200 + i, words(50, random.Random(i))) for i in range(30)]
    other = [(100 + i, " ".join("".join(random.Random(i * 50 + k).choices("wxyzjqüö", k=5)) for k in range(50))) for i in range(30)]
    docs = docs_of(rows, lang="aa").unionByName(docs_of(other, lang="bb")).unionByName(docs_of(ODD + [(500, "123 %%")], lang=None))
    got = {r["doc_id"]: r for r in rows_of(language_id.identify(docs, ~held_out("doc_id", 3, 1)))}
    assert all(got[i]["lang_pred"] == "aa" for i, _ in rows) and all(got[i]["lang_pred"] == "bb" for i, _ in other)
    assert all(got[i]["lang_pred"] == "und" for i in (1, 2, 3, 500))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = rows_of(language_id.identify(docs_of(ODD, lang=None), ~held_out("doc_id", 3, 1)))
    assert {r["lang_pred"] for r in none} == {"und"} and len(none) == len(ODD)


def test_every_labelled_language_is_learned(docs_of):
    rng, docs, truth = random.Random(6), None, {}
    for i in range(35):
        tongue = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 7))) for _ in range(30)]
        some = [(100 * i + k, " ".join(rng.choices(tongue, k=40))) for k in range(40 - i)]
        truth |= {n: f"l{i:02}" for n, _ in some}
        docs = docs_of(some, lang=f"l{i:02}") if docs is None else docs.unionByName(docs_of(some, lang=f"l{i:02}"))
    got = rows_of(language_id.identify(docs.coalesce(2), F.col("doc_id") % 100 > 1))
    assert {r["doc_id"]: r["lang_pred"] for r in got} == truth


@pytest.mark.parametrize("module, column", [(pu_toxicity, "toxic"), (pu_quality, "quality")])
def test_classifiers_learn(spark, docs_of, module, column):
    mark = "vile scum" if column == "toxic" else "#### $$$$ ####"
    bad = range(0, 300, 3)
    rows = [(i, words(40, random.Random(i)) + (" " + " ".join([mark] * 4) if i in bad else "")) for i in range(300)]
    ones = set(bad) if column == "toxic" else set(range(300)) - set(bad)
    labels = spark.createDataFrame([(i, int(i in ones)) for i in range(300)] + [(None, 1), (999, None)], f"doc_id bigint, {column} int")
    got = rows_of(module.score(docs_of(rows + ODD), labels, ~held_out("_id", 5, 0)))
    assert len(got) == 300 + len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    right = [r["predicted"] == int(r["doc_id"] in ones) for r in got if r["doc_id"] is not None and (r["doc_id"] > 12) and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean(right) > 0.95
    empty = rows_of(module.score(docs_of(ODD), labels.where("false"), ~held_out("_id", 5, 0)))
    assert len({r["score"] for r in empty}) == 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav><div class="ad">Buy now this</div>
%s<h1>Title &amp; more</h1><p>First   paragraph&#33;<br>goes on <b>bold</b></p><p>Second &lt;one&gt;</p>
<form><label>Name</label><input></form><div class="comments"><p>nice post</p></div>%s<aside>Related things here</aside>
<footer>&copy; someone</footer></body></html>"""


def test_main_text(spark):
    pages = [(i, f"u{i}", PAGE % ("<article>", "</article>")) for i in range(20)]
    pages += [(50, "u", PAGE % ("<div>", "</div>")), (51, None, None), (52, "u", ""), (53, "u", "<p>only text"), (None, "u", "no markup")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as _html")
    got = {r["page_id"]: r for r in rows_of(html_extract.main_text(df))}
    want = "Title & more\n\nFirst paragraph! goes on bold\n\nSecond <one>"
    assert all(got[i]["text"] == want and got[i]["n_chars"] == len(want) for i in [*range(20), 50])
    assert got[51]["text"] == got[52]["text"] == "" and got[53]["text"] == "only text" and got[None]["text"] == "no markup"


def test_empty_tables(spark, docs_of):
    none = docs_of(ODD).where("false")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    training = ~held_out("doc_id", 3, 1)
    for found in (
        quality_rules.judge(none), lm_scoring.score(none, training), jaccard_join.join(none), bpe.encode(none, bpe.default_path()),
        mixing.taken(none), exact_dedup.exact_groups(none), language_id.identify(none, training),
        pu_quality.score(none, labels, held_out("_id", 4, 2)), pu_toxicity.score(none, labels, held_out("_id", 5, 0)),
        html_extract.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")),
    ):
        assert found.count() == 0


def test_remainder(spark):
    row = spark.range(50).select("id", remainder("id", 7).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 7 for r in row)


def test_queries_are_named():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("size", [3, 500, 6000])
def test_sketches_rule_out_the_unlike_and_never_a_link(size):
    rng = np.random.default_rng(size)
    tokens = rng.integers(0, 1 << 63, 3 * size, dtype=np.uint64)
    near = size // 12
    sets = [tokens[:size], tokens[near : size + near], tokens[size : 2 * size], tokens[: size // 2]]
    key = np.concatenate([np.sort(x) for x in sets])
    row = np.repeat(np.arange(4), [len(x) for x in sets])
    found = jaccard_join.sketches(key, row, 4).to_pylist()
    n = np.array([len(x) for x in sets])
    left, right = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 2])
    odd = jaccard_join.odd_bits([found[i] for i in left], [found[i] for i in right])
    differ = [len(set(sets[i].tolist()) ^ set(sets[j].tolist())) for i, j in zip(left, right)]
    assert (odd <= differ).all()
    kept = jaccard_join.may_link(n[left], n[right], odd, 80)
    assert kept[0] == (100 * (size - near) >= 80 * (size + near))
    if size > 3:
        assert not kept[1:].any()


def test_the_scan_finds_the_best_run():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 30))]
        a, b = html_extract.best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0.0, *sums])


def around(page, opening, closing):
    return re.sub(r"(<body[^>]*>)(.*)(</body>)", lambda m: m[1] + opening + m[2] + closing + m[3], page, flags=re.S)


def test_names_of_frames_and_content_hide_no_article(spark):
    pages = [r.html for r in spark.read.parquet(f"{SMALL_DIR}/pages.parquet").orderBy("page_id").limit(40).collect()]
    counts = {}
    for (kind, inside), n in html_extract.kind_counts(pages).items():
        counts.setdefault(kind, [0, 0])[0 if inside else 1] += n
    weights = html_extract.weigh({k: tuple(v) for k, v in counts.items()})
    form = '<form method="post"><input type="hidden" name="state" value="1">'
    long = [p for p in pages if len(html_extract.extract(p, weights)) > 500]
    assert len(long) >= 10
    for page in long[:10]:
        text = html_extract.extract(page, weights)
        for opening, closing in (('<div class="page has-sidebar">', "</div>"), (form, "</form>"), ('<div id="sidebar-wrapper">', "</div>")):
            assert html_extract.extract(around(page, opening, closing), weights) == text
        first = text.split("\n\n")[0]
        at = page.index("<p>", page.index("<body"))
        for name in ('class="share-price"', 'id="related-work"'):
            more = page[:at] + f"<div {name}><p>One more paragraph of the text itself.</p></div>" + page[at:]
            if first in html_extract.extract(more, weights) and at > page.find("<h1"):
                assert "One more paragraph of the text itself." in html_extract.extract(more, weights)
        for name in ('class="ad-banner"', 'class="cookie notice"', "role=search"):
            less = page[:at] + f"<div {name}>Buy this now.</div>" + page[at:]
            assert "Buy this now." not in html_extract.extract(less, weights)
        signup = '<form action="/s"><p>Sign up for letters.</p><input name="mail"><button>Go</button></form>'
        assert "Sign up" not in html_extract.extract(page[:at] + signup + page[at:], weights)


def test_components_of_few_edges_are_one_task(spark, docs_of):
    edges = [(i, i * 7919 % 601) for i in range(400)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(kept, ("40", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("few-edges", "components")
        found = {r["_class"]: r["_root"] for r in jaccard_join.components(spark.createDataFrame(edges, "_a long, _b long")).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in kept.items():
            spark.conf.set(k, v)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i)
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert found == {x: top(x) for e in edges for x in e if e[0] != e[1]}
    assert tasks < 200


@pytest.mark.parametrize("size", (1, 60, 300, 426, 700, 3000))
def test_short_sketches_rule_out_the_unlike_and_never_a_link(spark, docs_of, size):
    rng = np.random.default_rng(size)
    one, other = rng.integers(0, 1 << 62, (2, size), np.uint64)
    near = np.concatenate([one[size // 9 :], other[: size // 10]])
    key, row = np.concatenate([one, near, other]), np.repeat(np.arange(3), (len(one), len(near), len(other)))
    rows = list(zip(range(3), map(int, np.bincount(row)), jaccard_join.sketches(key, row, 3).to_pylist()))
    made = jaccard_join.shortened(spark.createDataFrame(rows, "_class long, n_shingles long, _sketch binary")).orderBy("_class").collect()
    parts, n = [r["_part"] for r in made], np.array([r["n_shingles"] for r in made])
    assert all(4 * len(p) <= len(r[2]) for p, r in zip(parts, rows))
    odd = jaccard_join.odd_bits(parts[:1] * 2, parts[1:])
    may = jaccard_join.may_link(n[[0, 0]], n[1:], odd, 80)
    assert odd[0] <= len(np.setxor1d(one, near)) and may[0] and (size == 1 or not may[1])

def test_bits_are_counted_in_blocks_of_slots(spark, docs_of):
    rows = spark.createDataFrame([(w.encode(), c, n) for w, c, n in (("word", 3, 5), ("wo", 3, 70), ("", 0, 2), ("x" * 90, 1, 1))] * 3, "_word binary, _class int, n long")
    code = lm_scoring.byte_code(rows)
    blocks = lm_scoring.count_bits(rows.repartition(3), code)
    want = np.zeros((int(lm_scoring.OFFSETS[-1]), 2))
    own = [tuple(r) for r in rows.collect()]
    walk = lm_scoring.Walk(code, [bytes(r[0]) for r in own], np.array([r[1] for r in own]))
    n = np.array([r[2] for r in own])[walk.owner]
    for piece, _, bit, slots in walk:
        for slot in slots:
            np.add.at(want, (slot, bit), n[piece])
    assert blocks.count() <= len(want) // lm_scoring.SLOTS
    assert np.allclose(lm_scoring.bit_counts(blocks.toArrow()), want, rtol=1e-3)


def test_contexts_of_some_rows_are_those_of_all():
    b = lm_scoring.Batch(pa.array(["a b c", "", None, "a", "b a b a c", "c"]))
    gram, keys = lm_scoring.gram_keys(b)
    for first, last in ((0, 3), (3, 4), (3, 6), (1, 3)):
        some = slice(*np.searchsorted(b.row, (first, last)))
        part, levels = lm_scoring.gram_keys(b, some)
        assert (part == gram[some]).all() and all((levels[k] == keys[k][some]).all() for k in keys)


def test_buckets_of_one_hub_are_looked_at_once_where_they_are_alike(spark, docs_of):
    rng = random.Random(4)
    buckets = {k: [1000, *rng.sample(range(20), 18)] for k in range(30)}  # much the same members
    buckets |= {100 + k: [2000, *range(100 + 10 * k, 110 + 10 * k)] for k in range(8)}  # nothing in common but the hub
    buckets |= {200: [3000, 300], 201: [3000, 301, 302]}  # one that its hub has seen, one of a single component else
    root = {c: 7 for c in (3, 5, 8)} | {301: 301, 302: 301}
    members = spark.createDataFrame([(k, c) for k, own in buckets.items() for c in own], "_key long, _class long")
    hubs = jaccard_join.leaders(members, F.col("_class"))
    assert {r["_key"]: r["_hub"] for r in hubs.collect()} == {k: own[0] if own[0] >= 1000 else max(own) for k, own in buckets.items()}
    pairs = {tuple(r) for r in jaccard_join.hub_pairs(members, hubs).collect()}
    assert pairs == {(own[0], c) for own in buckets.values() for c in own[1:]}
    found = jaccard_join.rest_groups(members, hubs, spark.createDataFrame(list(root.items()), "_class long, _root long")).collect()
    assert all(r["_root"] == root.get(r["_class"], r["_class"]) for r in found)
    groups = {}
    for r in found:
        groups.setdefault(r["_key"], []).append(r["_class"])
    assert {k: sorted(own) for k, own in groups.items()} == {1000: list(range(20))} | {100 + k: list(range(100 + 10 * k, 110 + 10 * k)) for k in range(8)}


def test_grams_move_by_short_names_and_meet_once(spark, docs_of):
    texts = ["a b a b c", "b a b c c a b", "a b c", None, "", "c", "a b a b c"]
    train = [True, True, False, True, True, True, True]
    hashes = {w: lm_scoring.Batch(pa.array([w])).hash[0] for w in "abc"}
    frequent = np.sort(np.array([hashes["a"], hashes["b"]]))
    name = dict(zip("abc", lm_scoring.word_names(frequent, np.array([hashes[w] for w in "abc"])).tolist(), strict=True))
    assert sorted(name.values())[1:] == [1, 2] and name["c"] < 0
    batch = lm_scoring.Batch(pa.array(texts))
    price = {k: float(i) for i, k in enumerate(np.sort(batch.key).tolist())}
    costs = (np.sort(batch.key), np.arange(len(batch.key), dtype=float))
    rows = spark.createDataFrame(list(zip(texts, train, strict=True)), "_text string, _train boolean").coalesce(1)
    grams = lm_scoring.count_grams(rows, spark.sparkContext.broadcast(None), costs, frequent)
    assert grams.columns == ["_u", "_v", "_w", "_class", "_cost", "_n"]
    seen = lm_scoring.seen_after(grams, 2)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1
    want, cost = Counter(), {}
    for row, (t, known) in enumerate(zip(texts, train, strict=True)):
        own = (t or "").split()
        for i, w in enumerate(own):
            at = (name[own[i - 2]] if i > 1 else 0, name[own[i - 1]] if i else 0, name[w])
            want[(*at, int(batch.klass[row]))] += known
            cost[name[w], int(batch.klass[row])] = price[int(lm_scoring.pair_key(np.array([hashes[w]]), batch.klass[[row]])[0])]
    of = lambda at: sum(n for x, n in want.items() if x[: len(at)] == at)
    got = {tuple(r)[:4]: r for r in seen.collect()}
    assert {at: r["_n"] for at, r in got.items()} == dict(want)
    for at, r in got.items():
        followed = {x[2] for x, n in want.items() if n and x[:2] == at[:2]}
        assert (r["_k2"], r["_all2"], r["_kinds2"], r["_cost"]) == (of(at[:3]), of(at[:2]), len(followed), cost[at[2:]])


def test_bpe_words_of_one_length_are_scanned_together(monkeypatch):
    from tokenizers import Tokenizer

    code = bpe.Codec(bpe.default_path())
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdeé '1.\n", k=300)) for _ in range(40)] + ["", "<|endoftext|>a <|endoftext|>", "it's 12 ½", "x" * 200, "　a\x1fb\xa0 c"]
    calls, scans = [], bpe.Codec.scans
    monkeypatch.setattr(bpe.Codec, "scans", lambda self, ids: calls.append(ids.shape) or scans(self, ids))
    ids, ends = code.encode_all(texts)
    library = Tokenizer.from_file(bpe.default_path())
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert code.decode_all(ids, ends) == texts
    assert len({n for _, n in calls}) == len(calls) < sum(n for n, _ in calls) / 10
    monkeypatch.setattr(bpe, "REMEMBERED", 2)  # what was met before stays for one turn, long words never do
    code.encode_all(texts[:2])
    n = len(calls)
    again, _ = code.encode_all(texts[:2])
    assert len(calls) == n and (again == ids[: len(again)]).all() and not any(len(w) > bpe.SHORT for w in code.known)


def test_words_are_counted_in_one_expression(spark):
    rows = [(t,) for t in ("", None, " ", "a", " a\nb\tc\x0b\x0cd\r ", "  x", "é\x00 y\xa0z", "\x85 w")]
    counted = spark.createDataFrame(rows, "text string").select("text", n_words("text").alias("n"))
    assert all(r["n"] == len(WORD.findall(r["text"] or "")) for r in counted.collect())
    assert "translate" not in counted._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("pairs", (1, 50, 1 << 17))
def test_pairs_of_blocks_are_looked_at_together(spark, monkeypatch, pairs):
    """The likely pairs of groups of all sizes against brute force, each block in few steps."""
    rng = np.random.default_rng(8)
    groups = {k: sorted(rng.choice(900, n, replace=False).tolist()) for k, n in enumerate([2, 3, 7, 40, 300, 700])}
    root = {c: c % 50 if c % 3 else c for c in range(900)}
    base = rng.integers(0, 1 << 62, (30, 80), np.uint64)
    sets = [np.unique(np.concatenate([base[c % 30][: 70 + c % 7], rng.integers(0, 1 << 62, 4, np.uint64)])) for c in range(900)]
    key, row = np.concatenate(sets), np.repeat(np.arange(900), [len(s) for s in sets])
    sketch, size = jaccard_join.sketches(key, row, 900).to_pylist(), np.array([len(s) for s in sets])
    classes = spark.createDataFrame(list(zip(range(900), size.tolist(), sketch, strict=True)), "_class long, n_shingles long, _sketch binary").coalesce(2)
    rows = spark.createDataFrame([(k, c, root[c]) for k, own in groups.items() for c in own], "_key long, _class long, _root long").coalesce(2)
    monkeypatch.setattr(jaccard_join, "PAIRS", pairs)
    got = {tuple(r) for r in jaccard_join.rest_pairs(rows, classes, 80).collect()}
    a, b = (np.array(x) for x in zip(*sorted({(max(x, y), min(x, y)) for own in groups.values() for x in own for y in own if x < y and root[x] != root[y]}), strict=True))
    good = jaccard_join.may_link(size[a], size[b], jaccard_join.odd_bits([sketch[x] for x in a], [sketch[x] for x in b]), 80)
    assert got == set(zip(a[good].tolist(), b[good].tolist(), strict=True)) and got


def test_lm_scoring_prices_are_no_nested_expressions(spark):
    rows = spark.createDataFrame([(1, 2, w, 0, 9.0, w % 3) for w in range(20)], "_u long, _v long, _w long, _class int, _cost double, _n long")
    prices = lm_scoring.priced(rows)
    plan = prices._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "log2(" not in plan.lower()
    assert prices.columns == ["_u", "_v", "_w", "_class", "_cost"] and prices.count() == 20


def test_shares_serve_the_occurrences_best():
    rng = np.random.default_rng(3)
    n, cost = rng.integers(1, 5, 400), rng.uniform(1, 40, 400)
    k = n + rng.integers(0, 3, 400)
    counts = (k, k + rng.integers(0, 60, 400), rng.integers(1, 4, 400))
    odds, of = lm_scoring.follows(counts, True)
    sums = lm_scoring.tried(n, cost, counts)
    for i, share in enumerate(lm_scoring.SHARES):
        bits = lm_scoring.mixed(cost, odds, np.full(400, share))
        assert np.allclose(2.0**-bits, (1 - share) * 2.0**-cost + share * odds)
        assert np.allclose(sums[:, i], np.bincount(of[of >= 0], (n * bits)[of >= 0], len(sums)))
    assert lm_scoring.gate(np.array([0, 1, 7, 8, 1 << 40]), np.array([0, 1, 7, 2, 1 << 40])).tolist() == [-1, 0, 12, 20, 138]
