"""Every stage and the whole pipeline against plain Python, on tables with nulls, repeated rows and clashing names."""

import hashlib
import random
import re
from collections import Counter

import pytest
from test_operators import ODD, docs_of, words  # noqa: F401

import corpus_pipeline
from pagetables.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def family(seed, n):
    """A text and near copies of it, one word replaced in each."""
    text = words(120, random.Random(seed)).split()
    out = [" ".join(text)]
    for i in range(n):
        some = list(text)
        some[7 * i + 3] = f"new{i}"
        out.append(" ".join(some))
    return out


ROWS = [*ODD, (None, None), (40, words(60)), (40, words(60)), *[(50 + i, t) for i, t in enumerate(family(1, 4))]]
ROWS += [(60, family(2, 0)[0])] * 3 + [(None, t) for t in family(3, 2)] + [(70, family(3, 3)[3]), (71, "  " + family(1, 0)[0].replace(" ", "\n", 5))]
CLASHES = ("_copies", "_copy", "_own", "_row", "_lead", "_first", "_named", "_gone", "_share", "_c0", "_run", "_norm")


@pytest.fixture(scope="module")
def odd(docs_of):  # noqa: F811
    df = docs_of(ROWS)
    for name in CLASHES:
        df = df.selectExpr("*", f"'x{name}' as {name}")
    return df


def found(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def order_of(i):
    return (i is None, i or 0)


def one_of_each(rows, same):
    """Row numbers that stay: of every group of rows that ``same`` connects, the first by identifier."""
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if same(a, b) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    out = {}
    for a, g in enumerate(group):
        if g not in out or order_of(rows[a][0]) < order_of(rows[out[g]][0]):
            out[g] = a
    return set(out.values())


def test_exact_dedup_stage(spark, odd):
    texts = [normal(t) for _, t in ROWS]
    stays = one_of_each(ROWS, lambda a, b: texts[a] == texts[b])
    got = exact_dedup.stage(spark, odd, "")
    assert got.columns == odd.columns
    assert Counter((i, normal(t)) for i, t in found(got).elements()) == Counter((ROWS[a][0], texts[a]) for a in stays)


def test_jaccard_stage(spark, odd):
    sets = [shingle_set(t) for _, t in ROWS]
    like = lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    stays = one_of_each(ROWS, like)
    got = jaccard_join.stage(spark, odd, "")
    assert got.columns == odd.columns
    assert Counter((i, frozenset(shingle_set(t))) for i, t in found(got).elements()) == Counter((ROWS[a][0], frozenset(sets[a])) for a in stays)


def test_quality_stage(spark, odd):
    got = quality_rules.stage(spark, odd, "")
    assert got.columns == odd.columns
    gone = {r["doc_id"] for r in quality_rules.judge(odd).collect() if not r["kept"]}
    assert found(got) == Counter(r for r in ROWS if r[0] not in gone)


def test_mixing_stage(spark, odd):
    got = mixing.stage(spark, odd, "")
    assert got.columns == odd.columns
    copies = found(got)
    assert copies == found(mixing.stage(spark, odd, ""))  # a second run agrees
    take = {}
    for r in mixing.taken(odd).collect():
        size, taken = take.get(r["doc_id"], (0, 0))
        take[r["doc_id"]] = (size + r["size"], taken + r["taken"])
    repeated = Counter(ROWS)
    for row, n in copies.items():
        size, taken = take[row[0]]
        assert taken / size - 1 < n / repeated[row] < taken / size + 1
    assert all(WORD.search(t or "") for _, t in copies)


def test_bpe_stage(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.default_path())
    want = Counter()
    for i, t in ROWS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.stage(spark, odd, "").collect()) == want


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, odd, stage):
    assert stage(spark, odd.limit(0), "").collect() == []


def test_the_pipeline_is_its_stages(spark, tmp_path, docs_of):  # noqa: F811
    rng = random.Random(5)
    clean = [(1000 + i, words(rng.randint(40, 200), rng)) for i in range(150)]
    rows = clean + [(2000 + i, clean[i][1]) for i in range(20)] + [(3000 + i, clean[i][1] + " more words") for i in range(20, 40)]
    rows += [(4000 + i, "too short") for i in range(5)] + [(5000, None)]
    for n, (part, source) in enumerate(((rows[:100], "a"), (rows[100:], "b"))):
        docs_of(part, source=source).coalesce(1).write.mode("append" if n else "overwrite").parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs).collect()}
    kept = [r for r in rows if verdict[r[0]]]
    assert not any(verdict[i] for i, _ in rows if i >= 4000) and sum(verdict[i] for i, _ in clean) >= 148
    texts = [normal(t) for _, t in kept]
    kept = [kept[a] for a in sorted(one_of_each(kept, lambda a, b: texts[a] == texts[b]))]
    sets = [shingle_set(t) for _, t in kept]
    size = [len(s) for s in sets]
    near = lambda a, b: 100 * min(size[a], size[b]) >= 80 * max(size[a], size[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    kept = {kept[a][0] for a in one_of_each(kept, near)}
    assert not any(2000 <= i < 4000 for i in kept)
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert set(got) <= kept and len(set(got)) > 0.6 * len(kept)
    assert max(Counter(got).values()) <= 3
