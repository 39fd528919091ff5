"""Every operator on odd rows, on an empty table, and against a plain or brute-force version."""

import hashlib
import random
import types
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from millrace.llm import components, exact_dedup, jaccard_join, language_id, license_scan, mixing, packing, quality_classifier, quality_rules, queries, sharding, tokens, url_filter
from millrace.llm.common import Shared, named_words, shingle_sets, table, word_hashes, words_of

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def collect(df):
    return [r.asDict() for r in df.collect()]


# ---- hashes -----------------------------------------------------------------


def test_words_and_shingles_follow_their_definition():
    texts = ["", " ", "a", "A b\tC\nd\x0be  f", "x" * 5000 + " y", "\u00a0é É"]
    for t in texts:
        buffer, start, end = words_of(t.encode())
        assert [bytes(buffer[a:b]).decode() for a, b in zip(start, end)] == named_words(t)
        assert len(set(word_hashes(buffer, start, end))) == len(set(named_words(t)))
    sets = list(shingle_sets([t.encode() for t in texts], 5, step=8))
    assert [len(s) for s in sets] == [0, 0, 1, 2, 1, 1]
    one, two = shingle_sets([b"a b c", b"A  b\nc"], 5)
    assert list(one) == list(two)


# ---- 1 ----------------------------------------------------------------------


def brute_components(rows, percent=80):
    sets = []
    for _, t in rows:
        w = named_words(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = defaultdict(list)
    for (d, _), g in zip(rows, group):
        least[g] += [d] if d is not None else []
    return [(d, len(s), min(least[g]) if least[g] else None) for (d, _), s, g in zip(rows, sets, group)]


def near_copies(seed, n):
    rnd = random.Random(seed)
    rows, base = [], []
    for i in range(n):
        if base and rnd.random() < 0.7:
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 1, 2, 4])):
                k = rnd.randrange(len(w))
                w[k : k + rnd.choice([0, 1, 2])] = [f"n{rnd.randrange(50)}"] * rnd.choice([0, 1, 2])
        else:
            w = [f"w{rnd.randrange(60)}" for _ in range(rnd.choice([3, 20, 40, 60]))]
        base.append(w or ["x"])
        rows.append((i * 7 % n, " ".join(base[-1])))
    return rows


@pytest.mark.parametrize("options", [{}, {"hot_rows": 2, "owner_rows": 100, "broadcast_rows": 0}])
def test_jaccard_components_equal_brute_force(spark, options):
    rows = near_copies(5, 260)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in collect(jaccard_join.jaccard_components(spark, docs, **options)))
    assert got == sorted(brute_components(rows))


def test_jaccard_on_odd_rows(spark, odd_docs, no_docs, rows):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in collect(jaccard_join.jaccard_components(spark, odd_docs)))
    assert got == Counter(brute_components([(d, t) for d, t, *_ in rows]))
    assert collect(jaccard_join.jaccard_components(spark, no_docs)) == []


def numbered(case, n, changes=(), extra=()):
    """A text of n words that no other case has, some replaced by words of the same length."""
    return " ".join([f"{case}{'x' if i in changes else 'w'}{i:03d}" for i in range(n)] + list(extra))


def odd_links():
    """Cases whose rows don't meet, one after the other; ids of a case lie in a hundred of their own."""
    long = [f"y{i}" for i in range(14)]
    cases = [
        lambda t: [(1, t()), (None, t(extra=["a"])), (3, t(extra=["a", "b"]))],
        # the chain from 1 to 9 passes through a row without an id
        lambda t: [(9, t(extra=long)), (None, t(extra=long[:7])), (1, t())],
        lambda t: [(None, t()), (None, t(extra=["a"]))],
        # two texts of one length under one id, in either order
        lambda t: [(5, t()), (5, t(changes=range(60))), (7, t(extra=["zzz"]))],
        lambda t: [(5, t(changes=range(60))), (5, t()), (7, t(extra=["zzz"]))],
        lambda t: [(7, t(extra=["zzz"])), (5, t(changes=range(60))), (5, t()), (2, t(changes=range(60), extra=["q"]))],
    ]
    return [(None if d is None else 100 * k + d, t) for k, case in enumerate(cases) for d, t in case(lambda k=k, **more: numbered(k, 60, **more))]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_links_of_rows_without_ids_or_under_one_id(spark, broadcast_rows):
    rows = odd_links()
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in collect(jaccard_join.jaccard_components(spark, docs, broadcast_rows=broadcast_rows)))
    assert got == Counter(brute_components(rows))


def test_a_bucket_of_many_components(spark):
    """Many unlike texts share one passage, some have near copies; buckets are paired in blocks."""
    rnd, shared = random.Random(8), [f"s{i}" for i in range(30)]
    rows = []
    for i in range(80):
        own = [f"t{rnd.randrange(40)}" for _ in range(rnd.choice([6, 8, 30]))]
        rows.append((2 * i, " ".join(shared + own)))
        if i % 3 == 0:
            rows.append((2 * i + 1, " ".join(shared + own[:-1] + ["end"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in collect(jaccard_join.jaccard_components(spark, docs, block_rows=5, hot_rows=20)))
    assert got == sorted(brute_components(rows))


def test_histograms_never_refuse_a_link():
    rnd = np.random.default_rng(4)
    for n, both in ((20, 19), (400, 380), (40_000, 38_000)):
        h = np.unique(rnd.integers(0, 2**64 - 1, 2 * n, dtype=np.uint64))
        x, y = np.sort(rnd.permutation(h)[:n]), None
        y = np.sort(np.append(x[rnd.permutation(n)[:both]], rnd.integers(0, 2**64 - 1, n - both, dtype=np.uint64)))
        pair = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([n]), pa.array([n]), pa.array([jaccard_join.histogram(x)]), pa.array([jaccard_join.histogram(y)])], names=["a", "b", "a_n", "b_n", "a_hist", "b_hist"])
        assert next(iter(jaccard_join._may_share(80)([pair]))).num_rows == 1


def test_leaders_reach_their_members():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        start = rnd.random(40) < 0.2
        start[0] = True
        n = rnd.integers(1, 60, 40)
        lead = jaccard_join.leaders(start, n, 80)
        heads = []
        for i in range(40):
            heads = [] if start[i] else heads
            near = [h for h in heads if 100 * min(n[i], n[h]) >= 80 * max(n[i], n[h])]
            heads += [] if near else [i]
            assert lead[i] == (near or [i])[0]


@pytest.mark.parametrize("hub_rows", [7, 100_000])
def test_components_of_a_long_path_and_a_hub(spark, hub_rows):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in collect(components.connected_components(Shared(spark, "test"), spark.createDataFrame(edges, "a long, b long"), hub_rows=hub_rows))}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}


def jobs_of(spark, name, run):
    """The rows of a query, and how many jobs it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return collect(run()), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(key, None)


@pytest.mark.parametrize("edges, roots, most", [([], {}, 8), ([(1, 2), (1, 3), (7, 9), (9, 7)], {1: 1, 2: 1, 3: 1, 7: 7, 9: 7}, 8), ([(1, 2), (2, 3)], {1: 1, 2: 1, 3: 1}, 20)])
def test_settled_components_take_no_round(spark, edges, roots, most):
    edges = spark.createDataFrame(edges, "a long, b long")
    got, jobs = jobs_of(spark, f"components of {roots}", lambda: components.connected_components(Shared(spark, "test"), edges))
    assert {r["node"]: r["root"] for r in got} == roots and jobs <= most


def test_a_join_without_gaps_takes_few_jobs(spark):
    """Two stars of near copies, and two texts that share a passage but aren't linked: every link is found in the first step."""
    rnd = random.Random(3)
    words = [[f"w{k}x{rnd.randrange(900)}" for _ in range(60)] for k in range(4)]
    rows = [(10 * k + i, " ".join(w + ["end"] * i)) for k, w in enumerate(words[:2]) for i in range(3)]
    rows += [(30, " ".join(words[2])), (40, " ".join(words[2][:20] + words[3][20:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, jobs = jobs_of(spark, "join without gaps", lambda: jaccard_join.jaccard_components(spark, docs))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_components(rows))
    assert jobs <= 65


# ---- 2 ----------------------------------------------------------------------


def brute_mix(rows, weights=(3, 1, 2)):
    sizes, total = defaultdict(int), 0
    for _, t, s in rows:
        sizes[s] += len(named_words(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        share = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share >= 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full} if full else {s: weight[s] * share for s in open_}
        open_ = open_ - full if full else set()
    out = []
    for s in names:
        left = int(target[s])
        order = sorted((r for r in rows if r[2] == s), key=lambda r: (hashlib.md5(f"{hashlib.md5(r[1].encode()).hexdigest() if r[0] is None else r[0]}:mix".encode()).hexdigest(), r[0] or -1))
        epochs = left // sizes[s] if sizes[s] else 0
        left -= epochs * sizes[s]
        for d, t, _ in order:
            n = len(named_words(t or ""))
            take = min(n, left)
            left -= take
            out.append((d, n, sizes[s], round(target[s], 6), epochs * n + take))
    return out


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 1, "broadcast_rows": 0}])
def test_mixing_equals_brute_force(spark, odd_docs, no_docs, rows, options):
    got = Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in collect(mixing.mix_sources(spark, odd_docs, **options)))
    assert got == Counter(brute_mix([(d, t, s) for d, t, _, s in rows]))
    assert collect(mixing.mix_sources(spark, no_docs)) == []


def test_mix_carries_columns_and_reruns_agree(spark):
    docs = table(spark, SF, "documents")
    one = sorted((r["doc_id"], r["taken"], r["text"]) for r in collect(mixing.mix_sources(spark, docs, carry=("text",))))
    assert one == sorted((r["doc_id"], r["taken"], r["text"]) for r in collect(mixing.mix_sources(spark, docs.repartition(7), carry=("text",), bucket_rows=10)))


# ---- 3, 4 -------------------------------------------------------------------


def test_license_scan_on_odd_rows(spark, odd_docs, no_docs):
    got = {r["doc_id"]: r for r in collect(license_scan.scan_licenses(spark, odd_docs))}
    assert len(got) == 13 and got[4]["n_words"] == 0 and got[4]["labels"] == "" and got[4]["first_word"] is None
    assert (got[None]["labels"], got[None]["base_labels"], got[None]["score"]) == ("mit", "", 1.0)
    twelve = got[12]
    assert (twelve["n_base"], twelve["first_word"], twelve["last_word"], twelve["base_labels"], twelve["score"]) == (5, 0, 12, "cc-by,gpl,reserved", 1.0)
    assert collect(license_scan.scan_licenses(spark, no_docs)) == []


def told(template, block):
    must, without = license_scan.MARKS.get(template, ("", ""))
    return set(must.split()) <= set(block) and not set(without.split()) & set(block)


def test_siblings_are_told_apart(spark):
    """A license named in a template's frame has its own label or none, never its sibling's."""
    rows = [
        ("Licensed under CC BY 4.0", {"cc-by"}), ("Licensed under CC BY-NC 4.0", {"cc-by", "cc-by-nc"}), ("licensed under CC BY-SA 4.0.", {"cc-by", "cc-by-sa"}),
        ("Licensed under CC BY-NC-SA 4.0", {"cc-by", "cc-by-nc-sa"}), ("Licensed under CC BY-ND 4.0", {"cc-by", "cc-by-nd"}), ("Licensed under CC BY-NC-ND 4.0", {"cc-by", "cc-by-nc-nd"}),
        ("released under the BSD license", set()), ("Released under the MIT license", {"mit"}), ("released under the apache license", set()),
        ("This work is licensed under the GNU General Public License version 2", {"gpl"}), ("this work is licensed under the license of the general public, version 3", set()),
        ("Licensed under the Eclipse license version 2.0", set()), ("This work is licensed under a Creative Commons Attribution-ShareAlike license", set()), ("copyright all rights waived", set()),
        ("a\nLicensed under\nCC BY-NC 4.0 but not\nCC BY-SA 4.0 licensed under cc by-sa 4.0", {"cc-by", "cc-by-nc", "cc-by-sa"}),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    for windows in (False, True):
        got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in collect(license_scan.scan_licenses(spark, docs, windows=windows))}
        assert [got[i] for i in range(len(rows) - 1)] == [labels for _, labels in rows[:-1]]
    assert got[len(rows) - 1] == rows[-1][1]


def test_license_prefix_join_loses_nothing(spark):
    rnd = random.Random(3)
    vocabulary = sorted({w for t, _ in license_scan.TEMPLATES for w in t.split()}) + ["other", "words"]
    rows = []
    for i in range(300):
        lines = []
        for _ in range(rnd.randrange(3)):
            t = rnd.choice(license_scan.TEMPLATES)[0].split()
            lines.append(" ".join(w if rnd.random() < 0.85 else rnd.choice(vocabulary) for w in t))
        rows.append((i, "\n".join(lines)))
    got = {r["doc_id"]: r for r in collect(license_scan.scan_licenses(spark, spark.createDataFrame(rows, "doc_id long, text string")))}
    for i, text in rows:
        found, best = set(), 0
        for line in text.split("\n"):
            for t, label in license_scan.TEMPLATES:
                want = set(t.split())
                share = len(want & set(line.split())) / len(want) if told(t, line.split()) else 0
                if share >= license_scan.THRESHOLD:
                    found.add(label)
                    best = max(best, share)
        base = set(filter(None, got[i]["base_labels"].split(",")))
        assert set(filter(None, got[i]["labels"].split(","))) == found | base
        assert got[i]["score"] == pytest.approx(1.0 if base else best)


def test_license_notices_over_line_ends(spark, tmp_path):
    far = "released " + "x " * 3000 + "under " + "x " * 3000 + "mit " + "x " * 3000 + "license"
    rows = [
        (1, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided", {"bsd"}),
        (2, "licensed under the Apache\nLicense,\n\nVersion 2.0", {"apache"}),
        (3, far, set()),
        (4, "Released, as of now, under the\twell known MIT license", {"mit"}),
        (5, "x " * 500 + "released under the MIT license " + "x " * 500, {"mit"}),
    ]
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in collect(queries.op3_license_scan(spark, str(tmp_path)))}
    assert {i: set(filter(None, r["labels"].split(","))) for i, r in got.items()} == {i: labels for i, _, labels in rows}


def test_license_windows_equal_brute_force(spark):
    rnd = random.Random(8)
    vocabulary = sorted({w for t, _ in license_scan.TEMPLATES for w in t.split()}) + ["other", "words"]
    rows = []
    for i in range(200):
        words = []
        for _ in range(rnd.randrange(1, 4)):
            t = rnd.choice(license_scan.TEMPLATES)[0].split()
            words += [w if rnd.random() < 0.9 else rnd.choice(vocabulary) for w in t] + rnd.choices(vocabulary, k=rnd.randrange(12))
        rows.append((i, "".join(w + rnd.choice("    \n") for w in words)))
    got = {r["doc_id"]: r for r in collect(license_scan.scan_licenses(spark, spark.createDataFrame(rows, "doc_id long, text string"), windows=True))}
    for i, text in rows:
        found, best = set(), 0
        for t, label in license_scan.TEMPLATES:
            want, n, words = set(t.split()), len(t.split()), text.split()
            blocks = [words[k : k + n] for k in range(len(words))] + [x for x in map(str.split, text.split("\n")) if len(x) <= 2 * n]
            share = max((len(want & set(b)) / len(want) for b in blocks if told(t, b)), default=0)
            if share >= license_scan.THRESHOLD:
                found.add(label)
                best = max(best, share)
        base = set(filter(None, got[i]["base_labels"].split(",")))
        assert set(filter(None, got[i]["labels"].split(","))) == found | base
        assert got[i]["score"] == pytest.approx(1.0 if base else best)


def test_quality_rules_on_odd_rows(odd_docs, no_docs, rows):
    got = defaultdict(list)
    for r in collect(quality_rules.quality_rules(odd_docs)):
        got[r["doc_id"]].append(r)
    assert len(got[9]) == 2
    for d, t, *_ in rows:
        w = (t or "").split(" ") if d == 11 else [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")]
        w = [x for x in w if x]
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        r = got[d][0]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "")
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["kept"] and r["base_failed"])
    assert collect(quality_rules.quality_rules(no_docs)) == []


# ---- 5, 9 -------------------------------------------------------------------


def brute_bits(counts, text):
    """Code length of a text under one language by walking the contexts byte by byte, with exclusion."""
    s = language_id.BEFORE + text

    def p(context, symbol):
        below = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 256)
        seen = counts.get(context, {})
        total, kinds = sum(seen.values()), len(seen)
        if total < language_id.LEAST and context or not seen:
            return below(symbol)
        if symbol in seen:
            return seen[symbol] / (total + kinds)
        return kinds / (total + kinds) * below(symbol) / (1 - sum(below(x) for x in seen))

    return sum(-np.log2(p(s[i - language_id.ORDER : i], s[i])) for i in range(language_id.ORDER, len(s)))


def test_code_lengths_equal_a_walk_through_the_tree():
    learned = {"xx": b"the cat and the hat", "yy": "der hut und die k\u00fche der".encode(), "zz": "\u0434\u043e\u043c \u0438 \u0434\u044b\u043c".encode()}
    counts, grams = {}, {}
    for lang, t in learned.items():
        grams[lang] = np.unique(language_id.keys_of(np.frombuffer(language_id.BEFORE + t, np.uint8)), return_counts=True)
        counts[lang] = defaultdict(Counter)
        s = language_id.BEFORE + t
        for i in range(language_id.ORDER, len(s)):
            for k in range(language_id.ORDER + 1):
                counts[lang][s[i - k : i]][s[i]] += 1
    model = language_id.build(grams)
    probe = [b"the hut", "und k\u00fche? 12".encode(), b"", "\u0434\u044b\u043c THE \u0434\u043e\u043c\x00\xff".encode("utf-8"), bytes(range(256)), b"zzz " * 9000]
    for step in (1 << 17, 50):
        got = language_id.code_lengths(model, probe, step)
        for i, t in enumerate(probe[:5]):
            for j, lang in enumerate(model.languages):
                assert got[i, j] == pytest.approx(brute_bits(counts[lang], t), rel=1e-5)
        assert got[5] == pytest.approx(language_id.code_lengths(model, probe[5:])[0], rel=1e-6)


def test_scripts_of_several_bytes_are_told_apart():
    """Near languages in one non-Latin script, by the letters that one of them lacks."""
    rnd = random.Random(1)
    letters = {"ru": "\u0430\u0431\u0432\u0433\u0434\u0435\u0436\u0437\u0438\u044b\u044d\u044a", "uk": "\u0430\u0431\u0432\u0433\u0434\u0435\u0436\u0437\u0438\u0456\u0457\u0454"}
    text = lambda lang, n: " ".join("".join(rnd.choice(letters[lang]) for _ in range(rnd.randint(2, 7))) for _ in range(n)).encode()
    model = language_id.build({lang: np.unique(np.concatenate([language_id.keys_of(np.frombuffer(language_id.BEFORE + text(lang, 40), np.uint8)) for _ in range(20)]), return_counts=True) for lang in letters})
    for j, lang in enumerate(model.languages):
        assert (language_id.code_lengths(model, [text(lang, 12) for _ in range(40)]).argmin(1) == j).all()


def test_key_table():
    rnd = np.random.default_rng(3)
    keys = np.unique(rnd.integers(0, 1 << 44, 5000))
    table_, probe = language_id.KeyTable(keys), rnd.permutation(np.append(keys, rnd.integers(0, 1 << 44, 5000)))
    place = {k: i for i, k in enumerate(keys.tolist())}
    assert table_.find(probe).tolist() == [place.get(k, -1) for k in probe.tolist()]
    assert language_id.KeyTable(keys[:0]).find(keys[:3]).tolist() == [-1] * 3


def test_language_id(spark, odd_docs, no_docs):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.train(docs)
    got = {r["doc_id"]: r for r in collect(language_id.identify(spark, docs, model))}
    truth = {r["doc_id"]: r["lang"] for r in collect(docs.select("doc_id", "lang"))}
    held = [d for d, r in got.items() if r["held_out"]]
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == r["held_out"] for d, r in got.items())
    assert np.mean([got[d]["lang_pred"] == truth[d] for d in held]) > 0.97
    odd = {r["doc_id"]: r for r in collect(language_id.identify(spark, odd_docs, model))}
    assert [odd[i]["lang_pred"] for i in (4, 5, 6)] == ["und"] * 3 and odd[9]["lang_pred"] == "de"
    assert collect(language_id.identify(spark, no_docs, language_id.train(no_docs))) == []
    assert {r["lang_pred"] for r in collect(language_id.identify(spark, odd_docs, language_id.train(no_docs)))} == {"und"}


def test_quality_classifier(spark, odd_docs, no_docs):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    ranker = quality_classifier.train(docs, labels)
    got = {r["doc_id"]: r for r in collect(quality_classifier.score_quality(spark, docs, ranker))}
    held = [(r["quality"], got[r["doc_id"]]) for r in collect(labels) if got[r["doc_id"]]["held_out"]]
    good, bad = ([r["score"] for q, r in held if q == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) > 0.95
    assert np.mean([q == r["predicted"] for q, r in held]) > 0.9
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in got.values())
    odd = collect(quality_classifier.score_quality(spark, odd_docs, ranker, carry=("text", "size")))
    assert len(odd) == 14 and {r["size"] for r in odd} == {"x"}
    empty = quality_classifier.train(no_docs, labels)
    assert collect(quality_classifier.score_quality(spark, no_docs, empty)) == []
    assert {r["score"] for r in collect(quality_classifier.score_quality(spark, odd_docs, empty))} == {0.5}


def test_ranker_equals_plain_descent(spark):
    """Weights by gradient descent on the same pairs, the threshold by counting, scores one by one."""
    docs = {r["doc_id"]: r["text"] for r in collect(table(spark, "/root/testdata/sf0.01", "documents"))}
    known = sorted((r["doc_id"], r["quality"]) for r in collect(table(spark, "/root/testdata/sf0.01", "labels")) if r["quality"] is not None)[:150]
    x, label = np.array([quality_classifier.features((docs[d] or "").encode()) for d, _ in known]), np.array([q for _, q in known])
    pairs, ridge, cut, seed = 400, 0.05, 0.3, 3
    ranker = quality_classifier.fit(x, label, pairs, ridge, cut, seed)
    z = np.array([[min(8.0, max(-8.0, (v - m) / (s if s > 1e-9 else 1.0))) for v, m, s in zip(row, x.mean(0), x.std(0))] for row in x])
    rng, good, bad = np.random.default_rng(seed), np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(z.shape[1])
    for _ in range(60_000):
        w -= 0.02 * (diff.T @ (1 / (1 + np.exp(-diff @ w)) - 1) / pairs + ridge * w)
    assert ranker.weights == pytest.approx(w, abs=1e-3)
    s = z @ ranker.weights
    share = lambda t: (np.mean([v >= t for v in s[good]]) + np.mean([v < t for v in s[bad]])) / 2
    assert share(ranker.threshold) >= max(share(t) for t in s) - 0.02
    for d, _ in known[:20]:
        v = sum(min(8.0, max(-8.0, (f - m) / c)) * k for f, m, c, k in zip(quality_classifier.features((docs[d] or "").encode()), ranker.mean, ranker.scale, ranker.weights)) - ranker.threshold
        assert ranker.score(x[[i for i, (e, _) in enumerate(known) if e == d]])[0] == pytest.approx(1 / (1 + np.exp(-(v + np.log(cut / (1 - cut))))))


# ---- 6 ----------------------------------------------------------------------


@pytest.mark.parametrize("slot_rows", [50_000, 2])
def test_sharding_law_and_slots(spark, slot_rows):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = collect(sharding.shard_documents(spark, docs, shards=7, slot_rows=slot_rows))
    text = {r["doc_id"]: r["text"] for r in collect(docs)}
    assert len(got) == len(text) and all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["size"] == len(text[r["doc_id"]].encode()) + 16 for r in got)
    size, slots, where = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        where[text[r["doc_id"]]].add(r["shard"])
    assert sorted(size) == list(range(7)) and max(size.values()) < 1.03 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, where.values())) == 1


def test_tree_cuts_at_weighted_medians(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(1, 50), rnd.randrange(1000), rnd.randrange(10), 0, i) for i in range(500)]
    df = spark.createDataFrame(rows, "size long, x long, y long, tie_hash long, tie_id long")
    root = sharding.grow(df, 2, ["x", "y"], ["tie_hash", "tie_id"])
    total, (value, *_) = sum(r[0] for r in rows), root.cut.values
    at = lambda v: sum(r[0] for r in rows if r[1] <= v)
    best = min(abs(at(v) - total / 2) for v in range(1000))
    assert root.cut.keys[0] == "x" and (len(root.cut.values) > 1 or abs(at(value) - total / 2) <= max(best, 0.002 * total / 2))


def plain_tree(rows: list[dict], shards: int, dims: list[str], spread: dict[str, int], first: int = 0, miss: float = 0.01) -> dict[int, int]:
    """The shard of each row, by sorting each node's rows along each dimension; cuts are exact."""
    if shards < 2 or not rows:
        return {r["tie_id"]: first for r in rows}
    weight = sum(r["size"] for r in rows)
    goal, share = weight * (shards // 2) / shards, weight / shards

    def cut(keys, some, below):
        key, by = keys[0], defaultdict(list)
        for r in some:
            by[r[key]].append(r)
        left = []
        for v in sorted(by):
            w = sum(r["size"] for r in by[v])
            if below + w >= goal:
                break
            left, below = left + by[v], below + w
        near = min(goal - below, below + w - goal)
        if near > 0 and len(keys) > 1 and (key in dims or w > share):
            near, inner = cut(keys[1:], by[v], below)
            return near, left + inner
        return near, left + by[v] if below + w - goal <= goal - below else left

    wide = sorted(dims, key=lambda d: ((min(r[d] for r in rows) - max(r[d] for r in rows)) / spread[d], dims.index(d)))
    tried = [cut(keys, rows, 0) for keys in [*([d, "tie_hash", "tie_id"] for d in wide), ["tie_hash", "tie_id"]]]
    near, left = next((t for t in tried if t[0] <= miss * share), min(tried, key=lambda t: t[0]))
    ids = {r["tie_id"] for r in left}
    return plain_tree(left, shards // 2, dims, spread, first) | plain_tree([r for r in rows if r["tie_id"] not in ids], shards - shards // 2, dims, spread, first + shards // 2)


@pytest.mark.parametrize("sums, bins", [(1 << 16, 256), (16, 3)])
def test_every_level_of_the_tree_is_cut_as_by_sorting(spark, monkeypatch, sums, bins):
    """Smooth and tied dimensions, groups of equal texts lighter and heavier than a shard; a few bins force many refinements."""
    monkeypatch.setattr(sharding, "SUMS", sums)
    monkeypatch.setattr(sharding, "BINS", bins)
    rnd, rows = random.Random(5), []
    for group, n in [*((g, 1) for g in range(300)), (300, 20), (301, 60), (302, 150)]:
        one = {"size": rnd.randrange(16, 400), "x": rnd.randrange(100_000), "y": rnd.choice([0, 0, 0, 7, rnd.randrange(50)]), "tie_hash": zlib.crc32(b"%d" % group)}
        rows += [{**one, "tie_id": zlib.crc32(b"row %d" % (len(rows) + i))} for i in range(n)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "size long, x long, y long, tie_hash long, tie_id long")
    root = sharding.grow(df, 13, ["x", "y"], ["tie_hash", "tie_id"], tolerance=0)
    got = {r["tie_id"]: r["shard"] for r in collect(df.select("tie_id", sharding.leaf_of(root, lambda n: n.first).alias("shard")))}
    spread = {d: max(r[d] for r in rows) - min(r[d] for r in rows) for d in ("x", "y")}
    assert got == plain_tree(rows, 13, ["x", "y"], spread) and len(set(got.values())) == 13


def test_a_level_of_the_tree_takes_few_jobs(spark, monkeypatch):
    docs, taken, plain = table(spark, "/root/testdata/sf0.01", "documents"), [], sharding._histograms
    monkeypatch.setattr(sharding, "_histograms", lambda *a: taken.append(1) or plain(*a))
    collect(sharding.shard_documents(spark, docs))
    assert len(taken) <= 3 * 6  # 40 shards have six levels


def test_groups_that_fit_a_shard_stay_whole(spark):
    """Of the default 40 shards on sf0.01, where one group weighs a third of a shard."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = collect(sharding.shard_documents(spark, docs))
    size, where, weight = Counter(), defaultdict(set), Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        where[r["text_crc32"]].add(r["shard"])
        weight[r["text_crc32"]] += r["size"]
    assert all(len(s) == 1 for c, s in where.items() if weight[c] <= sum(size.values()) / 40)
    assert len(size) == 40 and max(size.values()) < 1.15 * min(size.values())


def test_sharding_splits_a_group_larger_than_a_shard(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([(i, "same") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(100)], "doc_id long, text string")
    size = Counter()
    for r in collect(sharding.shard_documents(spark, docs, shards=10)):
        size[r["shard"]] += r["size"]
    assert len(size) == 10 and max(size.values()) < 1.3 * min(size.values())
    odd = collect(sharding.shard_documents(spark, odd_docs))
    assert len(odd) == 14 and all(0 <= r["shard"] < 40 and r["law"] == "bytes" and r["grown_shard"] is None for r in odd)
    assert collect(sharding.shard_documents(spark, no_docs)) == []


# ---- 7 ----------------------------------------------------------------------


@pytest.mark.parametrize("shard_tokens", [4_000_000, 9_000, 1_500])
def test_packing_is_a_round_trip(spark, odd_docs, no_docs, rows, shard_tokens):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for d, t, *_ in rows:
        ids = np.append(np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4"), np.uint32(2)).astype("<u4")
        expected[(d, ids.tobytes())] += 1
    got = collect(packing.pack_documents(spark, odd_docs, TOKENIZER, shard_tokens=shard_tokens))
    ids_of = defaultdict(list)
    for (d, ids), n in expected.items():
        ids_of[d].append((np.frombuffer(ids, "<u4"), n))
    for d, kinds in ids_of.items():
        for ids, n in kinds:
            pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] == d)
            assert len(pieces) % n == 0 and sum(p[1] for p in pieces) == n * len(ids)
            assert all(zlib.crc32(ids[a : a + k].tobytes()) == c for a, k, c in pieces)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert collect(packing.pack_documents(spark, no_docs, TOKENIZER)) == []


def indexed(docs, idf=None):
    """Postings of lists of word numbers, with weights."""
    words = np.array([len(d) for d in docs])
    terms = np.array([t << 24 for d in docs for t in d], np.uint64)
    doc, term, tf, names = packing.postings(terms, words)
    df = np.bincount(term)
    weight = np.log1p((len(docs) - df + 0.5) / (df + 0.5))[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * words[doc] / words.mean()))
    return doc, term, weight.astype(np.float32)


def brute_bm25(docs, query):
    n, long = len(docs), np.mean([len(d) for d in docs])
    df = Counter(t for d in docs for t in set(d))
    return [sum(np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(d) / long)) for t, f in Counter(d).items() if t in set(query)) for d in docs]


def brute_chain(docs, window):
    """The greedy order with plain scores, counted over all documents."""
    order, filled = [], 0
    while len(order) < len(docs):
        seed = next(i for i in range(len(docs)) if i not in order)
        order.append(seed)
        filled = (filled + len(docs[seed]) + 1) % window
        if not filled:
            continue
        score = brute_bm25(docs, docs[seed])
        for i in sorted((i for i in range(len(docs)) if i not in order and score[i] > 0), key=lambda i: (-score[i], i)):
            order.append(i)
            filled += len(docs[i]) + 1
            if filled >= window:
                filled %= window
                break
    return order


@pytest.mark.parametrize("dense", [2, 10_000])
def test_scores_equal_bm25(dense):
    rnd = np.random.default_rng(0)
    docs = [rnd.integers(1, 50, rnd.integers(1, 60)).tolist() for _ in range(60)]
    index = packing.Bm25(*indexed(docs), len(docs), dense)
    for seed, score in zip((0, 7), index.scores([0, 7])):
        assert score == pytest.approx(brute_bm25(docs, docs[seed]), rel=1e-5)


def test_documents_follow_as_in_brute_force():
    rnd = np.random.default_rng(3)
    topics = [rnd.choice(5000, 40, replace=False) for _ in range(6)]
    docs = [rnd.choice(topics[i % 6], rnd.integers(20, 90)).tolist() for i in range(90)] + [[9999], []]
    order = packing.chain(*indexed(docs), np.array([len(d) + 1 for d in docs]), 300).tolist()
    assert sorted(order) == list(range(len(docs)))
    assert order == brute_chain(docs, 300)


def test_a_seed_s_light_terms_find_neighbours():
    seed = [t for t in range(1, 31) for _ in range(3)]  # 30 heavy terms, and a light one that the last document shares
    docs = [[*seed, 40], *([100 + i] * 50 for i in range(6)), [40, *range(200, 240)]]
    assert packing.chain(*indexed(docs), np.array([len(d) + 1 for d in docs]), 132)[:2].tolist() == [0, 7]


def test_neighbours_follow_a_seed_longer_than_a_window():
    docs = [list(range(1, 26)), list(range(50, 56)), list(range(20, 26))]
    assert packing.chain(*indexed(docs), np.array([len(d) + 1 for d in docs]), 20).tolist() == [0, 2, 1]


def topical(n=600, kinds=12):
    """Documents of a topic each, whose words stand in no other topic, and some words that all use."""
    rnd = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bcdfghjklm" for b in ("an", "or", "ist", "ent") for c in ("el", "um", "ita", "o", "esk")]
    rnd.shuffle(words)
    return [(i, " ".join(rnd.choice(words[8 + 16 * (i % kinds) :][:16] if rnd.random() < 0.6 else words[:8]) for _ in range(80))) for i in range(n)]


def test_a_range_of_long_documents_is_cut_in_order_of_the_key(spark):
    """Eight times as many tokens in one topic's rows as in all others', no ids: more shards than ranges, and every piece in its place."""
    rnd = random.Random(11)
    words = [["%s%d" % (t, i) for i in range(60)] for t in ("left", "right", "short")]
    texts = [" ".join(rnd.choices(words[i % 3], k=8 if i % 3 == 2 else 200)) for i in range(240)]
    packed = packing.pack_documents(spark, spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"), TOKENIZER, window=512, shard_tokens=9_000)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Sort [key" in plan and plan.index("MapInArrow") < plan.index("Sort [key") < plan.index("rangepartitioning")
    pieces, ids = defaultdict(list), 0
    for r in collect(packed):
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
        ids += r["length"]
    encoder = tokens.tokenizer_at(TOKENIZER)
    assert ids == len(encoder.encode(pa.array(texts))[0]) + len(texts)
    for some in pieces.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length


def test_shards_hold_a_seed_s_neighbours(spark):
    """Recall of the ten best neighbours over all documents, in the shard of the seed, where texts have topics."""
    rows = topical()
    got = collect(packing.pack_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, window=1500, shard_tokens=30_000))
    shard = {r["doc_id"]: r["sequence_id"] >> 32 for r in got}
    assert len(set(shard.values())) >= 3
    docs, found = [t.split() for _, t in rows], []
    for seed in range(0, len(docs), 80):
        score = brute_bm25(docs, docs[seed])
        best = sorted((i for i in range(len(docs)) if i != seed), key=lambda i: -score[i])[:10]
        found.append(np.mean([shard[i] == shard[seed] for i in best]))
    assert np.mean(found) >= 0.9


def test_windows_hold_one_topic(spark):
    rows = topical(240)
    got = collect(packing.pack_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, window=1500))
    in_window = defaultdict(set)
    for r in got:
        in_window[r["sequence_id"]].add(r["doc_id"])
    pairs = [(a, b) for ids in in_window.values() for a in ids for b in ids if a < b]
    assert np.mean([a % 12 == b % 12 for a, b in pairs]) > 0.5


def test_best_first_equals_a_full_sort():
    rnd = np.random.default_rng(1)
    for n in (5, 64, 300):
        score = rnd.integers(0, 9, n) / 4
        assert list(packing.best_first(score)) == sorted(np.flatnonzero(score > 0), key=lambda i: (-score[i], i))


@pytest.mark.parametrize("fast", [True, False])
def test_cached_ids_equal_the_tokenizer_s(rows, fast):
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(TOKENIZER), tokens.WordTokenizer(TOKENIZER, table_size=3)
    assert own.dtype == "<u2" and own.final.sum() > 20_000
    own.fast = own.fast if fast else None
    rnd = random.Random(0)
    noise = ["".join(rnd.choice("aB1é ,.'\x1c\x1f\x85\u00a0\u0301\u2028İßΣ\t\x0b<|>\x01") for _ in range(60)) for _ in range(300)]
    texts = [t or "" for _, t, *_ in rows] + noise
    for part in (texts, *([t] for t in texts)):
        ids, long = own.encode(pa.array(part))
        edge = np.append(0, np.cumsum(long))
        for i, t in enumerate(part):
            assert ids[edge[i] : edge[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_fast_merges_equal_the_tokenizer_s():
    """Every word of the vocabulary, joined ones, and random letters."""
    from tokenizers import Tokenizer

    tok, own, rnd = Tokenizer.from_file(TOKENIZER), tokens.WordTokenizer(TOKENIZER), random.Random(2)
    known = [w for w in (name.removesuffix("</w>") for name in tok.get_vocab()) if w.isascii() and w.isalpha() and w == w.lower()]
    words = list({*known, *(rnd.choice(known) + rnd.choice(known) for _ in range(60_000)), *("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéüñß") for _ in range(rnd.randint(1, 14))) for _ in range(60_000))})
    assert own.fast
    assert own._ids(words, True)[0].tolist() == tok.encode(" ".join(words), add_special_tokens=False).ids


def test_words_of_ids():
    ids, long = np.array([1, 2, 9, 2, 1, 2, 9, 5], np.uint16), np.array([5, 0, 3])
    final = np.zeros(10, dtype=bool)
    final[[9, 5]] = True
    terms, words = tokens.word_terms(ids, long, final)
    assert words.tolist() == [2, 0, 2] and len(terms) == 4  # 1 2 9, 2 1 (its end is a word's), 2 9, 5
    assert len(set(terms.tolist())) == 4


# ---- 8 ----------------------------------------------------------------------


def test_propagation_that_does_not_converge_is_an_error(spark):
    hosts = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "host string, trust_seed double, distrust_seed double")
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "src string, dst string, weight double")
    for rounds, tolerance in ((8, None), (400, 1e-6)):
        assert url_filter.propagate(Shared(spark, "rank"), hosts, edges, rounds=rounds, tolerance=tolerance).count() == 2
    with pytest.raises(ValueError, match="still move after 8 rounds"):
        url_filter.propagate(Shared(spark, "rank"), hosts, edges, rounds=8, tolerance=1e-12)


def brute_rank(seeds, edges, rounds=12, damping=0.85):
    total = sum(seeds.values())
    mass = {h: s / total for h, s in seeds.items() if s}
    start, out = dict(mass), Counter()
    for a, _, w in edges:
        out[a] += w
    for _ in range(rounds):
        new = defaultdict(float, {h: (1 - damping) * s for h, s in start.items()})
        for a, b, w in edges:
            new[b] += damping * mass.get(a, 0) * w / out[a]
        mass = new
    return mass


@pytest.mark.parametrize("hub_rows", [2, 1_000_000])
def test_propagation_equals_brute_force(spark, hub_rows):
    rnd = random.Random(4)
    hosts = [f"h{i}" for i in range(12)]
    edges = sorted({(rnd.choice(hosts), rnd.choice(hosts)) for _ in range(40)})
    edges = [(a, b, float(1 + (len(a + b) + i) % 3)) for i, (a, b) in enumerate(edges)]
    trust, distrust = {"h1": 2.0, "h2": 1.0}, {"h3": 1.0}
    hd = spark.createDataFrame([(h, trust.get(h, 0.0), distrust.get(h, 0.0)) for h in hosts], "host string, trust_seed double, distrust_seed double")
    got = {r["host"]: r for r in collect(url_filter.propagate(Shared(spark, "test"), hd, spark.createDataFrame(edges, "src string, dst string, weight double"), hub_rows=hub_rows))}
    good, bad = brute_rank(trust, edges), brute_rank(distrust, [(b, a, w) for a, b, w in edges])
    for h in hosts:
        if h in got:
            assert (got[h]["trust"], got[h]["distrust"]) == (pytest.approx(good.get(h, 0)), pytest.approx(bad.get(h, 0)))
        else:
            assert not good.get(h) and not bad.get(h)


def brute_judge(pages, least=1e-9):
    """Every page's verdict by plain rules and masses propagated until they stand still."""
    links, seen = Counter(), defaultdict(list)
    for host, path, out in pages:
        fits = [(len(h + p), v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        seen[host].append(max(fits)[1] if fits else None)
        links.update((host, to) for to in set(out) - {host})
    edges = [(a, b, float(n)) for (a, b), n in sorted(links.items())]
    trust = {h: float(v.count("allow")) for h, v in seen.items() if "block" not in v}
    distrust = {h: float(v.count("block")) for h, v in seen.items() if 2 * v.count("block") >= len(v)}
    rank = lambda seeds, e: brute_rank(seeds, e, 400) if sum(seeds.values()) else {}
    good, bad = rank(trust, edges), rank(distrust, [(b, a, w) for a, b, w in edges])
    blocked = {h for h in seen if bad.get(h, 0) > least / len(seen) and bad.get(h, 0) >= good.get(h, 0)}
    done = Counter()
    out = []
    for host, _, _ in pages:
        out.append(seen[host][done[host]] or ("block" if host in blocked else "allow"))
        done[host] += 1
    return out


def test_whole_judgement_equals_brute_force(spark):
    """A graph of sites with hosts under rules, pages without ids, repeated pages and one very long page."""
    rnd = random.Random(12)
    hosts = [f"h{i}.test" for i in range(14)] + ["a.net", "b.net", "www.example.net", "x.example.com", "s.org"]
    pages = []
    for i in range(90):
        host = rnd.choice(hosts)
        pages.append((host, rnd.choice(["/en/", "/de/1", "/fr/", "/"]), rnd.sample(hosts, rnd.choice([0, 1, 1, 3]))))
    pages.append((hosts[0], "/", hosts[1:4] * 20_000))
    rows = [(None if i % 7 == 0 else i % 50, f"http://{h}{p}", "".join(f"<a href='http://{x}/'>x</a>" for x in out)) for i, (h, p, out) in enumerate(pages)]
    got = Counter((r["page_id"], r["host"], r["path"], r["verdict"]) for r in collect(url_filter.judge_urls(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))))
    assert got == Counter((r[0], h, p, v) for r, (h, p, _), v in zip(rows, pages, brute_judge(pages)))


def test_distrust_reaches_past_twelve_links(spark):
    rows = [(i, f"http://h{i}.test/", f"<a href='http://h{i + 1}.test/'>" if i < 19 else "<a href='http://bad.net/'>") for i in range(20)]
    pages = spark.createDataFrame([*rows, (20, "http://bad.net/", ""), (21, "http://h99.test/", "")], "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in collect(url_filter.judge_urls(spark, pages))}
    assert got == {i: "block" for i in range(21)} | {21: "allow"}


def test_urls(spark):
    rows = [
        (1, "https://A.Example.NET/en/x?q#f", None),
        (2, "https://example.net/fr/", ""),
        (3, "http://www.example.com/de/1", "<a href='http://x'>"),
        (4, "http://myexample.com/de/1", "<A class=b HREF=\"https://www.example.com/en/1\">"),
        (5, "http://org", None),
        (6, "http://b.org/fr/", None),
        (7, None, None),
        (8, "no scheme/de/", "x"),
        (9, "ftp://h.test?x=/de/", None),
        (10, "x://good.test/", "<a href=//b.org/fr/>"),
        (10, "x://good.test/", "<a href=//b.org/fr/>"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, verdict string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in collect(url_filter.judge_urls(spark, pages))]
    assert sorted(got, key=str) == sorted([
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "example.net", "/fr/", "net/", "block"),
        (3, "www.example.com", "/de/1", "example.com/de/", "block"),
        (4, "myexample.com", "/de/1", None, "block"),
        (5, "org", "", None, "allow"),
        (6, "b.org", "/fr/", "org/fr/", "allow"),
        (7, "", "", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "h.test", "", None, "allow"),
        (10, "good.test", "/", None, "allow"),
        (10, "good.test", "/", None, "allow"),
    ], key=str)
    assert collect(url_filter.judge_urls(spark, pages.limit(0))) == []


# ---- 10 ---------------------------------------------------------------------


def test_rice_code_is_a_round_trip():
    rnd = np.random.default_rng(1)
    for values in ([0], [1], [5, 6, 7], rnd.integers(0, 2**40, 500), rnd.integers(0, 2**63, 300), [0, 2**59]):
        v = np.unique(np.array(values, dtype=np.uint64))
        k, code = exact_dedup.rice_encode(v)
        assert exact_dedup.rice_decode(len(v), k, code).tolist() == v.tolist()


@pytest.mark.parametrize("options", [{}, {"owner_rows": 1, "broadcast_rows": 0}])
def test_exact_dedup_on_odd_rows(spark, odd_docs, no_docs, rows, options):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(d)
    expected = Counter()
    for t, ids in groups.items():
        best, stays = max((d for d in ids if d is not None), default=None), True
        for d in ids:
            kept = d == best and stays
            stays = stays and not kept
            expected[(d, best, len(ids), kept, hashlib.sha256(t.encode()).hexdigest())] += 1
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in collect(exact_dedup.exact_dedup(spark, odd_docs, **options)))
    assert got == expected
    assert collect(exact_dedup.exact_dedup(spark, no_docs)) == []


@pytest.mark.parametrize("batch", [1, 1000])
def test_a_shard_ends_inside_a_batch(batch):
    texts = pa.array([f"w{i % 7} some words of a text x{i}" for i in range(200)])
    ids, long = tokens.tokenizer_at(TOKENIZER).encode(texts)
    rows = pa.RecordBatch.from_arrays([pa.array(range(200)), tokens.binary_of(ids, long).cast(pa.binary()), pa.array(long + 1)], names=["doc_id", "ids", "tokens"])
    most, chain = [], packing.chain
    table = types.SimpleNamespace(value=zlib.compress(bytes(1 << packing.SLOT_BITS)))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(packing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
        m.setattr(packing, "chain", lambda *a: most.append(int(a[3].sum())) or chain(*a))
        run, _ = packing._pack(TOKENIZER, 64, 150, table, 200, 7.0)
        got = [r for b in run(iter([rows.slice(i, batch) for i in range(0, 200, batch)])) for r in b.to_pylist()]
    assert sum(r["length"] for r in got) == int((long + 1).sum()) and {r["doc_id"] for r in got} == set(range(200))
    assert max(most) < 300 + int(long.max()) + 1 and len(most) > 3


def test_postings_of_parts_are_those_of_the_whole():
    texts = pa.array(["", "a b a c", "c d", " ".join(f"x{i % 50}" for i in range(300)), "", "b"])
    tok = tokens.tokenizer_at(TOKENIZER)
    ids, long = tok.encode(texts)
    terms, words = tokens.word_terms(ids, long, tok.final)
    whole = *packing.postings(terms, words), words
    for step in (1, 5, 1 << 20):
        for a, b in zip(packing.shard_postings(ids, long, tok.final, step), whole, strict=True):
            assert a.dtype == b.dtype and a.tolist() == b.tolist()
    assert [len(x) for x in packing.shard_postings(ids[:0], long[:0], tok.final)] == [0] * 5
    tok.forget()
    assert [x.tolist() for x in tok.encode(texts)] == [ids.tolist(), long.tolist()]
