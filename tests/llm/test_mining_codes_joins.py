"""Phrase mining, vector codes and the set join against brute force, on
whole small tables and on awkward rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conflux.llm import phrase_mining, registry, set_join, walsh_codes
from conflux.llm.bit_table import BitTable
from tests.llm.test_operators import AWKWARD, DOCS, SF


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# 11

def brute_counts(rows, longest=5):
    """{lang: Counter of phrases} and {lang: number of words} of (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(rows, least, top, percent=100):
    out = []
    f, n = brute_counts(rows)
    for lang, c in f.items():
        good = {p: a for p, a in c.items() if a >= least and " " in p}
        inside = defaultdict(int)
        for p, a in good.items():
            w = p.split(" ")
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    q = " ".join(w[i:i + k])
                    inside[q] = max(inside[q], a)
        kept = []
        for p, a in good.items():
            if 100 * inside[p] >= percent * a:
                continue
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = c[" ".join(w[:k])], c[" ".join(w[k:])]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            kept.append((-score, -a, p.encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def collocation_rows(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert collocation_rows(phrase_mining.collocations(docs, least=10, top=300)) == brute_collocations(rows, 10, 300)
    assert collocation_rows(registry.op11_toivonen_phrases(spark, SF)) == brute_collocations(rows, 100, 2000)


def test_border_failures_are_followed_until_closed(spark):
    """Whatever the sample proposes (here next to nothing), further passes find every phrase."""
    rows = [(f"common one two three four five, tail{i} one", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    f, _ = brute_counts(rows)
    want = sorted(("en", p, n) for p, n in f["en"].items() if n >= 20)
    for one_in in (1, 4, 10**9):
        found, passes = phrase_mining.frequent_phrases(docs, least=20, sample_one_in=one_in, filter_bits=16)
        assert sorted(tuple(r) for r in found.where("phrase <> ''").collect()) == want
        assert passes == (1 if one_in == 1 else passes) and passes <= 6
    assert passes == 2          # words, then them and what holds them


def test_failures_among_proposed_words_are_longer_each_time(spark, monkeypatch):
    """Nothing that holds a failure is counted with it: the border opens a word at a time, and closes all the same."""
    rows = [(f"common one two three four five, tail{i} one", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    f, _ = brute_counts(rows)
    want = sorted(("en", p, n) for p, n in f["en"].items() if n >= 20)
    for bits in (6, 12):          # a small table proposes some by chance
        found, passes = phrase_mining.frequent_phrases(docs, least=20, sample_one_in=10**9, filter_bits=bits)
        rows_ = [tuple(r) for r in found.where("phrase <> ''").collect()]
        assert sorted(rows_) == want and len(set(rows_)) == len(rows_)


def test_packed_counts_come_back():
    rng = np.random.default_rng(3)
    assert [phrase_mining.ranges_of(p) for p in (1, 200, 20_000)] == [10, 11, 18]
    for n, dealt in ((1, 10), (5, 18), (4000, 11)):
        h = rng.integers(0, 2**64, n, np.uint64)
        h = np.concatenate([h, h[:n // 2], np.array([0, 2**64 - 1], np.uint64)])
        counts = rng.choice([1, 1, 1, 2, 254, 255, 256, 510, 70_000], len(h))
        got, want = Counter(), Counter()
        for r, blob in phrase_mining.packed(h, counts, dealt):
            for x, c in zip(*phrase_mining.unpacked(r, blob, dealt), strict=True):
                assert int(x) >> (phrase_mining.KEPT - dealt) == r
                got[int(x)] += int(c)
        for x, c in zip(h, counts, strict=True):
            want[int(x) >> (64 - phrase_mining.KEPT)] += int(c)
        assert got == want


def test_sample_draws_short_runs_by_themselves(spark):
    """Of what one text or one piece repeats about its share is drawn, no phrase that isn't there, and all of it one in one."""
    rows = [("a b c. " * 4000, "en"), ("x y " * 30000, "en"), (None, None), ("", "en"), ("w" * 3000, "en")]
    texts = spark.createDataFrame(rows, "text string, lang string")
    for one_in in (1, 2, 8):
        got = " | ".join(r.text for r in phrase_mining.sampled_runs(texts, one_in).collect())
        for word, n in (("a", 4000), ("y", 30000)):
            assert abs(got.count(word) - n / one_in) < 0.25 * n / one_in
        f, _ = brute_counts([(got.replace("|", "."), "en")], 3)
        assert set(f["en"]) - {"w" * 3000} <= set(brute_counts(rows, 3)[0]["en"])


def test_a_full_bit_table_only_costs_time(spark):
    rnd = random.Random(4)
    rows = [(" ".join(rnd.choice("abcdefgh") for _ in range(200)), rnd.choice(["x", None])) for _ in range(12)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert collocation_rows(phrase_mining.collocations(docs, least=5, filter_bits=7)) == brute_collocations(rows, 5, 2000)


def test_sections_of_a_long_text_count_each_phrase_once(monkeypatch):
    import pyarrow as pa
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["ab", "É", " ", "  ", "\t", ". ", "\n", "x y ", "日本"]) for _ in range(rnd.randint(0, 300)))
             for _ in range(30)] + ["", "nogapsatall" * 20, " " * 50, "a, b" * 20]
    full = BitTable(8, np.full(4, 2**64 - 1, np.uint64))
    for most in (1, 7, 40):
        for text in texts:
            batch = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([None], pa.string())], names=["text", "lang"])
            got = Counter()
            for words, _ in phrase_mining.sections([batch], 5, most):
                for k, place, n, *_ in words.levels(5, full):
                    got.update(dict(zip(words.phrases(place, k).to_pylist(), n.tolist(), strict=True)))
            assert got == brute_counts([(text, None)])[0]["und"], (most, text)


def test_collocations_of_awkward_rows(awkward, empty):
    rows = [(r[1], r[2]) for r in AWKWARD]
    assert collocation_rows(phrase_mining.collocations(awkward, least=2, top=50)) == brute_collocations(rows, 2, 50)
    assert phrase_mining.collocations(empty).count() == 0


def test_products_beyond_64_bits(spark):
    """1000 a n passes 2^63 only with more words than a test can hold: the score's arithmetic alone."""
    a, n, left, right = 9 * 10**12, 10**14, 9 * 10**12, 9 * 10**13
    got = spark.sql(f"select (cast(cast({a} as decimal(16,0)) * 1000 as decimal(19,0)) * cast({n} as decimal(19,0)))"
                    f" div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) as s").first().s
    assert got == 1000 * a * n // (left * right)


# 12

def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    w = len(kept[0][1]) // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[near(cut(v)[p], books[p])[1]].append(cut(v)[p])
            books[p] = [[sum(c) // len(c) for c in zip(*groups[j], strict=True)] if j in groups else e
                        for j, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        found = [near(cut(v)[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(e for e, _ in found), lab))
    sums = Counter()
    for *_, e, lab in out:
        sums[lab] += e
    return sorted(((i, c, e, sums[lab], sha) for i, c, e, lab in out), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def code_rows(frame):
    return sorted((tuple(r) for r in frame.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_walsh_functions_are_in_sequency_order():
    for width in (1, 2, 4, 8, 32):
        h = walsh_codes.walsh(np.eye(width, dtype=np.int64)).T
        assert [int((r[1:] != r[:-1]).sum()) for r in h] == list(range(width))
        assert (h @ h.T == width * np.eye(width)).all()


def test_nearest_is_exact_with_ties_and_huge_values():
    rnd = np.random.default_rng(7)
    for w in (1, 3, 5, 8, 16, 21):
        for most in (2, 300, 2**40):
            parts, entries = (rnd.integers(-most, most, (n, w)) for n in (70, 23))
            entries[5] = entries[19] = parts[3]
            code, error = walsh_codes.nearest(parts, entries)
            d = [[sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True)) for b in entries] for a in parts]
            assert [int(c) for c in code] == [r.index(min(r)) for r in d] and code[3] <= 5
            assert [int(e) for e in error] == [min(r) for r in d]


def test_vector_codes_equal_brute_force(spark):
    got = code_rows(registry.op12_walsh_codes(spark, SF))
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got == brute_codes(rows)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert code_rows(walsh_codes.encode(table, entries=7, rounds=2)) == brute_codes(rows, entries=7, rounds=2)


def test_vector_codes_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.2, 0.3, 0.4], 1, "x"), (1, [0.1, -0.2, 0.3, 0.4], 1, "y"), (1, [0.0, -0.2, 0.3, 0.4], None, None),
            (None, [5.0, 5.5, -7.25, 1e6], None, "z"), (2, None, 1, "x"), (3, [nan, 0.0, 0.0, 0.0], 1, "x"),
            (4, [inf, 0.0, 0.0, 0.0], 2, "x"), (5, [None, 0.0, 0.0, 0.0], 2, "x"), (6, [], 2, "x"),
            (7, [0.0, 0.0, 0.0, 0.0], 2, "x"), (8, [-0.0, 1e-30, -1e-30, 0.0], 3, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v string")
    clean = [(i, v, lab) for i, v, lab, _ in rows]
    assert code_rows(walsh_codes.encode(frame, entries=3)) == brute_codes(clean, entries=3)
    assert code_rows(walsh_codes.encode(frame)) == brute_codes(clean)
    assert walsh_codes.encode(frame.where("vec_id = 2")).count() == 0
    clashing = frame.withColumnsRenamed({"v": "code"}).withColumns({"error": frame.label, "n": frame.label})
    assert code_rows(walsh_codes.encode(clashing)) == brute_codes(clean)
    for bad in ([(1, [0.1] * 4, 1), (2, [0.1] * 8, 1)], [(1, [0.1] * 6, 1)], [(1, [1e20] * 4, 1)]):
        with pytest.raises(Exception, match="components|too large"):
            walsh_codes.encode(spark.createDataFrame(bad, "vec_id long, embedding array<double>, label int")).count()


# 13

def brute_set(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(rows, percent=85):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by_shingle = defaultdict(list)
    for i, s in enumerate(sets):
        near = Counter(j for g in s for j in by_shingle[g])
        for j, common in near.items():
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                root[find(i)] = find(j)
        for g in s:
            by_shingle[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if r not in least or least[r] is None or (d is not None and d < least[r]) else least[r]
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)), key=lambda r: (r[0] is None, *map(str, r)))


def component_rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_shingles", "component_id").collect()),
                  key=lambda r: (r[0] is None, *map(str, r)))


def near_copies(seed, groups=4, size=40, words=150, shared=60):
    """Groups of near-copies with changes of 0 to 4 % of the words, a chain, and texts that share a long passage."""
    rnd = random.Random(seed)
    passage = [f"s{i}" for i in range(shared)]
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rnd.randint(0, 400)}" for _ in range(words)]
        for k in range(size):
            rate = rnd.choice([0, 0.005, 0.02, 0.04])
            rows.append((len(rows), " ".join(f"x{rnd.random()}" if rnd.random() < rate else w for w in base)))
        rows += [(len(rows) + k, " ".join([f"u{g}x{k}x{i}" for i in range(rnd.randint(3, 30))] + passage)) for k in range(size // 4)]
    chain = [f"c{i}" for i in range(120)]
    for k in range(30):
        chain = [w if rnd.random() > 0.01 else f"n{k}x{i}" for i, w in enumerate(chain)]
        rows.append((len(rows), " ".join(chain)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_set_join_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(set_join, "BLOCK", block)
    rows = near_copies(block)
    got = component_rows(set_join.joined(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute_components(rows)
    assert 10 < len({c for *_, c in got}) < len(rows) - 20


def test_set_join_of_documents_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert component_rows(registry.op13_set_relations(spark, SF)) == brute_components(rows)


def test_differences_give_the_links_of_a_group(spark):
    """Every link inside a leader's group, found without the sets."""
    rnd = random.Random(9)
    leader = set(range(200))
    rows, sets = [], {}
    for k in range(60):
        s = (leader - set(rnd.sample(range(200), rnd.randint(0, 40)))) | {1000 + rnd.randint(0, 60) for _ in range(rnd.randint(0, 25))}
        sets[k] = s
        rows.append((-1, k, len(s), sorted(s ^ leader), 200))
    sets[-1] = leader
    frame = spark.createDataFrame(rows, "leader long, nid long, size int, other array<long>, leader_size int")
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in set_join._group_links(frame, 85).collect():
        a, b = r.a, r.b
        assert 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
        root[find(a)] = find(b)
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                assert find(a) == find(b)


def test_set_join_of_awkward_rows(spark, awkward, empty):
    rows = [(r[0], r[1]) for r in AWKWARD]
    assert component_rows(set_join.joined(awkward)) == brute_components(rows)
    assert set_join.joined(empty).count() == 0
    null_ids = [(None, "one two three four five six"), (None, "ONE two three four five six"), (None, None), (None, "solo")]
    assert component_rows(set_join.joined(spark.createDataFrame(null_ids, "doc_id long, text string"))) == brute_components(null_ids)


def test_lowering_of_slices():
    import pyarrow as pa
    from conflux.llm.words import ascii_lowered
    a = pa.array(["ÀB cd", "", "Éx Yé", "ZZ é", "日本 A"] * 50, pa.large_string())
    for s in (a, a.slice(3), a.slice(7, 11), a.slice(1, 1), a.slice(0, 0)):
        ascii_lowered(s).validate(full=True)
        assert ascii_lowered(s).to_pylist() == [lowered(t) for t in s.to_pylist()]
