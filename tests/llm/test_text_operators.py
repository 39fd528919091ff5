"""Fill-in-middle, fingerprints and spelling variants against plain versions, on odd rows and on an empty table."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import fill_in_middle, fingerprints, spelling

SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


# ---- 11 ---------------------------------------------------------------------

UNITS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+", "character": r"(?s)."}


def plain_fim(doc_id, text, unit="line", percent=100, spm=50, seed=7, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(UNITS[unit], text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in marks) or h3 % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return doc_id, n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


LINED = [(i, t) for i, t in enumerate(["a\n", "\n", "\n\n\n", "a\nb", "no end", "x\n" * 50 + "y", "has <P> in it\nb\n", "<", "P>\n<\nS\n", "日本\n語 x\r\ny\n", "\x00\n\x00", "ends <\nS> starts"], 100)]


@pytest.mark.parametrize("options", [{}, {"unit": "word", "percent": 60, "seed": 3}, {"unit": "character", "spm": 100, "marks": ("[a]", "[b]", "[c]")}])
def test_fill_in_middle_is_the_plain_one(spark, rows, odd_docs, options):
    given = [(i, t) for i, t, _, _ in rows]
    more = {"spm_percent" if k == "spm" else k: v for k, v in options.items()}
    for docs, own in ((odd_docs, given), (frame(spark, LINED), LINED)):
        out = fill_in_middle.fill_in_middle(docs, **more, step=64)
        got = [tuple(r) for r in out.collect()]
        assert sorted(map(repr, got)) == sorted(repr(plain_fim(i, t, **options)) for i, t in own)
        back = out.select("doc_id", fill_in_middle.restored(out.output, out.form, more.get("marks", fill_in_middle.MARKS)).alias("t")).collect()
        assert sorted(repr(tuple(r)) for r in back) == sorted(repr((i, t or "")) for i, t in own)


def test_fill_in_middle_keeps_bytes_that_are_no_text(spark, no_docs):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('61FF0A62EDA0800A63') AS string) AS text")
    out = fill_in_middle.fill_in_middle(docs)
    made = out.select(out.output.cast("binary")).head()[0]
    assert sorted(made) == sorted(bytes.fromhex("61FF0A62EDA0800A63") + b"<P><S><M>") and bytes.fromhex("62EDA0800A") in made
    assert fill_in_middle.digests(fill_in_middle.fill_in_middle(no_docs)).collect() == []


def test_marks_that_overlap_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("<P", "P>", "<M>"), ("<P>", "<<P>>", "<M>"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            fill_in_middle._checked(marks)


# ---- 12 ---------------------------------------------------------------------


def phrases(text):
    return {int(n) for _, names, _ in fingerprints.parse([text]) for n in names}


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(words))


def test_phrases_cover_a_text_and_shrink_to_one():
    for text in ("a", "aa", "ab", "a" * 5000, "ab" * 700, prose(1, 400), "日本語テキスト" * 9, "\U0001f600x￿"):
        levels = list(fingerprints.parse([text]))
        assert all(long.sum() == len(text) for _, _, long in levels)
        counts = [len(names) for _, names, _ in levels]
        assert counts[-1] == 1 and all(b <= (a + 1) // 2 for a, b in zip(counts, counts[1:]))


def test_equal_substrings_share_their_phrases_at_any_offset():
    text = prose(2, 600)
    for front in ("x", "zq ", prose(3, 50), "e" * 100):
        whole = phrases(text)
        assert len(whole & phrases(front + text)) > 0.95 * len(whole)
        assert len(whole & phrases(text + front)) > 0.95 * len(whole)
    assert len(phrases(text) & phrases(prose(4, 600))) < 0.2 * len(whole)


def test_neighbouring_labels_differ():
    rnd = np.random.default_rng(5)
    for top in (2, 300, 1 << 60):
        names = rnd.integers(0, top, 5000).astype(np.uint64)
        names = names[np.append(True, names[1:] != names[:-1])]
        label = fingerprints._tossed(names, np.array([0, 1, 7, 900]))
        assert label.max() < 6 and all(a != b for k, (a, b) in enumerate(zip(label, label[1:]), 1) if k not in (1, 7, 900))


def test_a_sketch_does_not_hang_on_its_batch_or_bound():
    texts = [prose(k, n) for k, n in enumerate((0, 1, 3, 40, 300, 5000))] + ["ab " * 9000, "a" * 70_000, ""]
    together = fingerprints.sketches(texts, 16)
    for t, s in zip(texts, together):
        assert (s == fingerprints.sketches([t], 16)[0]).all()
        ranks = set()
        for _, names, long in fingerprints.parse([t]):
            ranks |= {int(np.float32((float(int(n) >> 11) + 1.0) / min(int(k), 32) ** 2).view(np.uint32)) for n, k in zip(names, long)}
        assert s.tolist() == sorted(ranks)[:16]


def test_edits_and_next_documents_by_plain_python(spark, rows, odd_docs, no_docs):
    given = sorted(((i, t or "") for i, t, _, _ in rows), key=lambda r: (r[0] is None, r[0]))
    given = [*given, *((100 + k, prose(k, 30 + k)) for k in range(40))]
    given.sort(key=lambda r: (r[0] is None, r[0] or 0))
    sketch = {t: fingerprints.sketches([t])[0] for _, t in given}
    want = []
    for (i, t), (_, following) in zip(given, given[1:] + given[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        new = fingerprints.sketches([edited])[0]
        hexed = lambda s: s.astype(">u4").tobytes().hex()
        want.append((i, len(t), SHA(edited), hexed(sketch[t]), hexed(new), fingerprints.alike(sketch[t], new), fingerprints.alike(sketch[t], sketch[following])))
    docs = odd_docs.select("doc_id", "text").union(frame(spark, [(100 + k, prose(k, 30 + k)) for k in range(40)]))
    for parts in ("1", "4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = [tuple(r) for r in fingerprints.fingerprint_edits(spark, docs, step=300).collect()]
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert fingerprints.fingerprint_edits(spark, no_docs).collect() == []
    one = fingerprints.fingerprint_edits(spark, frame(spark, [(1, "abcdefgh")])).head()
    assert (one.edited_sha256, one.near_next) == (SHA("abcdefab"), 1.0)


def test_fingerprints_without_a_neighbour_and_likeness_as_an_expression(spark, odd_docs, no_docs, rows):
    got = fingerprints.fingerprint_texts(odd_docs, step=100)
    prints = {r.doc_id: r.fingerprint for r in got.collect()}
    assert prints[1] == prints[2] and prints[4] == prints[5] == "" and len(prints) == len({i for i, *_ in rows})
    pairs = got.alias("a").crossJoin(got.alias("b")).selectExpr("a.fingerprint AS a", "b.fingerprint AS b")
    for r in pairs.select("a", "b", fingerprints.likeness(pairs.a, pairs.b).alias("x")).collect():
        a, b = (np.frombuffer(bytes.fromhex(f), ">u4").astype(np.uint32) for f in (r.a, r.b))
        assert r.x == fingerprints.alike(a, b)
    assert fingerprints.fingerprint_texts(no_docs).collect() == []


# ---- 13 ---------------------------------------------------------------------


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(docs, least=7, count=2, times=10, every=31):
    words = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += len(run) >= least
    words = {w: n for w, n in words.items() if n >= count}
    near = {w: [v for v in words if one_apart(v, w)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def misspelt(seed, stems, n):
    """Texts of stems by falling frequency, some letters left out, doubled or changed; few letters, so that errors meet halves."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abÀ×", k=rnd.randint(7, 13))) for _ in range(stems)]
    docs = []
    for i in range(n):
        text = []
        for _ in range(60):
            w = words[int(stems * rnd.random() ** 3)]
            for _ in range(rnd.choice((0, 0, 0, 1, 2))):
                k = rnd.randrange(len(w))
                w = rnd.choice((w[:k] + w[k + 1 :], w[:k] + w[k] + w[k:], w[:k] + rnd.choice("abcé") + w[k + 1 :]))
            text.append(w.title() if rnd.random() < 0.1 else w)
        docs.append((i, rnd.choice((" ", "1", "\n", "ʼ")).join(text)))
    return docs


@pytest.mark.parametrize("group_words", [100_000, 3])
def test_variants_are_the_plain_ones(spark, group_words):
    docs = misspelt(group_words, 40, 60)
    want = plain_variants(docs)
    got = [tuple(r) for r in spelling.spelling_variants(spark, frame(spark, docs), group_words=group_words).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(w[4] > 3 for w in want) > 20 and sum(w[1] is not None for w in want) > 10


def test_chains_of_forms_lead_to_their_root(spark):
    docs = [(None, "longword " * 2000), (1, "longwords " * 150), (2, "longwordss " * 12), (3, "longwordsss\n" * 2), (4, None), (5, ""), (6, "aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa")]
    for every in (0, 31):
        got = {r.word: r for r in spelling.spelling_variants(spark, frame(spark, docs), every=every, times=5).collect()}
        assert sorted(repr(tuple(r)) for r in got.values()) == sorted(map(repr, plain_variants(docs, every=every, times=5)))
    assert got["longwordss"].root == got["longwords"].root == "longword"


def test_variants_of_odd_rows(spark, rows, odd_docs, no_docs):
    want = plain_variants([(i, t) for i, t, _, _ in rows])
    assert sorted(repr(tuple(r)) for r in spelling.spelling_variants(spark, odd_docs).collect()) == sorted(map(repr, want))
    assert spelling.spelling_variants(spark, no_docs).collect() == []
    long = "a" * 3000
    docs = [(1, f"{long} {long} {long}b {long}b")]
    assert {r.n_near for r in spelling.spelling_variants(spark, frame(spark, docs), every=0).collect()} == {1}


def test_an_automaton_is_minimal_and_numbers_its_words():
    rnd = random.Random(8)
    words = sorted({"".join(rnd.choices("abc", k=rnd.randint(1, 6))) for _ in range(300)})
    rows, long = spelling.matrix(words, [()] * len(words))
    automaton = spelling.Automaton(rows, long)
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert automaton.states == len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes})
    for number, w in enumerate(words):
        state, total = np.array([automaton.root]), 0
        for c in w:
            edge, there = automaton.step(state, np.array([ord(c)]))
            assert there[0]
            state, total = automaton.target[edge], total + int(automaton.ahead[edge][0])
        assert automaton.final[state[0]] and total == number
    q, k = automaton.near(rows, long, np.zeros(len(words), np.int64))
    assert sorted(zip(q.tolist(), k.tolist())) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_apart(a, b)]
