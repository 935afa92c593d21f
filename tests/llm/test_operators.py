"""Each operator against plain Python on rows with nulls, empty and long texts, ties, repeated
rows and clashing column names, and on empty tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica.llm import (
    collision_ann,
    curriculum,
    decontaminate,
    language_id,
    license_scan,
    near_dedup,
    ppm,
    spans,
    substring_dedup,
    suffix_dedup,
    token_store,
)
from adjudica.llm.queries import tokenizer_path
from adjudica.llm.shared import components

#: Names the operators use themselves.
CLASHES = ("block", "kind", "node", "body", "packed", "runs", "b1", "b2", "rank", "target", "digest", "bucket", "words", "score", "_key", "c0", "draw")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def prose(seed, n, vocabulary=400):
    rng = np.random.default_rng(seed)
    syllables = ["an", "ter", "lo", "mi", "res", "to", "ka", "du", "en", "vor"]
    words = ["".join(rng.choice(syllables, 1 + i % 3)) + str(i % 7) * (i % 5 == 0) for i in range(vocabulary)]
    return " ".join(words[k] for k in rng.integers(0, vocabulary, n))


def edge_texts():
    base, passage = prose(1, 300), prose(2, 60)
    near = base.split()
    near[150] = "changed"
    long = prose(3, 12_000, 3000)
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "one two"),
        (9, "x " + passage + " y"), (10, prose(4, 50) + " " + passage), (11, passage + " " + prose(5, 40)),
        (12, long), (13, "a" * 700), (14, "é" * 150 + "ü" * 150), (15, "日本語 テキスト 🙂 don't <|endoftext|> MIT License ÀÉ"),
        (16, "Released under the MIT License.\nGNU general public LICENSE and gnu  General-public license"),
        (17, "cc by cc by " + prose(6, 100)), (None, "no id " + prose(7, 40)), (None, "no id " + prose(7, 40)), (None, None),
        (20, prose(8, 80)), (20, prose(8, 80)), (21, "12 34 !!"), (22, "Apache"),
        (23, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files " + prose(9, 30)),
    ]


@pytest.fixture(scope="module")
def rows():
    langs = ["en", "de", None]
    return [
        (i, t, langs[k % 3], [None, "b", "a", "c"][k % 4], k) + ("clash",) * len(CLASHES) for k, (i, t) in enumerate(edge_texts())
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def data(rows):
    return [(r[0], (r[1] or "").encode()) for r in rows]


def taken(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_ppm_equals_a_plain_trie(docs, rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    condition = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7, F.lit(0)) != 2
    trie, counts = ppm.Trie(), Counter()
    for i, t in data(rows):
        if not held(i):
            framed = b"\xff" * 4 + t + b"\xff"
            for k in range(4, len(framed)):
                trie.learn(framed[k - 4 : k], framed[k])
            counts.update([*t.lower().split(), b""])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in data(rows):
        w = [*t.lower().split(), b""]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want.append((i or -1, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6), round(trie.walk(t, False), 6)))
    got = [
        (r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in ppm.score_documents(docs, condition).collect()
    ]
    assert sorted(got) == sorted(want)


def test_ppm_is_a_distribution_and_adapts(docs):
    trie = ppm.Trie(2)
    trie.walk(b"abracadabra", True)
    for context in (b"br", b"zz", b"\xff\xff"):
        assert math.isclose(sum(10 ** trie.log10(context, s) for s in range(256)), 1.0, rel_tol=1e-9)
    scores = {r.doc_id: r.score for r in ppm.score_adaptively(docs.where("doc_id in (5, 7, 13)")).collect()}
    assert scores[13] > -60 and math.isclose(scores[5], -math.log10(256))


def test_ppm_without_training(spark, docs, empty):
    one = ppm.score_documents(docs.where("doc_id = 7"), F.lit(False)).first()
    assert one.train_tokens == 0 and math.isclose(one.score, -8 * math.log10(256))
    assert ppm.score_documents(empty, F.lit(True)).count() == 0


def test_license_scan(docs, rows, empty):
    phrases = {p.encode(): label for p, label in license_scan.PHRASES}
    want = Counter()
    for i, t in data(rows):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        places, labels = [], set()
        for p, label in phrases.items():
            q = p.split()
            for k in range(len(words) - len(q) + 1):
                if words[k : k + len(q)] == q:
                    places.append(k)
                    labels.add(label)
        want[i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    found = license_scan.scan(docs)
    assert taken(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[23].labels == "mit" and by_id[23].n_base == 0 and by_id[23].score == 1.0
    assert by_id[22].labels == "" and by_id[22].score == 0.0
    assert license_scan.scan(empty).count() == 0


def brute_blocks(words, templates, percent, stride):
    labels, best = set(), 0.0
    for b in range(max(1, math.ceil(len(words) / stride))):
        block = set(words[b * stride : (b + 2) * stride])
        for label, text in templates:
            t = set(text.split())
            if 100 * len(t & block) >= percent * len(t):
                labels.add(label)
                best = max(best, len(t & block) / len(t))
    return labels, best


def test_license_join_loses_no_block(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"t{k}", " ".join(rng.choice(vocabulary, 8, replace=False))) for k in range(6)]
    texts = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 150)))) for i in range(80)]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string"), templates, (), 75).collect()}
    for i, t in texts:
        labels, best = brute_blocks(t.split(), templates, 75, license_scan.STRIDE)
        assert got[i] == (",".join(sorted(labels)), round(best, 9))


def covered(units, window):
    """Units covered by windows that start at several places of all the texts."""
    count = Counter(tuple(u[k : k + window]) for u in units for k in range(len(u) - window + 1))
    out = []
    for u in units:
        marks = [False] * len(u)
        for k in range(len(u) - window + 1):
            if count[tuple(u[k : k + window])] > 1:
                marks[k : k + window] = [True] * window
        out.append(marks)
    return out


def test_suffix_dedup(docs, rows, empty):
    texts = data(rows)
    want = Counter()
    for (i, t), marks in zip(texts, covered([list(t) for _, t in texts], 200)):
        kept = bytes(c for c, m in zip(t, marks) if not m)
        spans = sum(m and (k == 0 or not marks[k - 1]) for k, m in enumerate(marks))
        want[i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert taken(suffix_dedup.repeat_digests(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_dedup.repeat_digests(empty).count() == 0


@pytest.mark.parametrize("sigma", [2, 3, 30])
def test_suffix_array_and_prefixes(sigma):
    rng = np.random.default_rng(sigma)
    for trial in range(60):
        n = int(rng.integers(1, 100))
        t = rng.integers(0, sigma, n)
        if trial % 3 == 0:
            t = np.tile(t[: max(1, n // 4)], 4)
            n = len(t)
        sa = suffix_dedup.suffix_array(t.astype(np.int16), sigma)
        assert sa.tolist() == sorted(range(n), key=lambda i: t[i:].tolist())
        stop = rng.random(n) < 0.05
        common = suffix_dedup.permuted_prefixes(t, sa, stop)
        for a, b in zip(sa[:-1], sa[1:]):
            k = 0
            while a + k < n and b + k < n and t[a + k] == t[b + k] and not stop[b + k]:
                k += 1
            assert common[b] == k


def test_substring_dedup(docs, rows, empty):
    texts = [(i, t.split()) for i, t in data(rows)]
    want = Counter()
    for (i, w), marks in zip(texts, covered([w for _, w in texts], 35)):
        kept = [x for x, m in zip(w, marks) if not m]
        want[i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    assert taken(substring_dedup.repeat_digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    spans = {r.doc_id: r.removed for r in substring_dedup.remove_repeated_words(docs).collect()}
    assert spans[9] == [[1, 61]] and spans[1] == [[0, 300]]
    assert substring_dedup.repeat_digests(empty).count() == 0


@pytest.mark.parametrize("operator", ["op7", "op3"])
def test_an_anchor_in_many_contexts_is_split(spark, monkeypatch, operator):
    phrase = prose(81, 20)
    texts = [(i, " ".join([prose(1000 + i, 40), phrase, prose(2000 + i, 40)])) for i in range(150)]
    # some contexts come again
    texts += [(500 + i, prose(3000 + i, 9) + " " + " ".join(texts[7 * i][1].split()[15 : 85 - i])) for i in range(15)]
    units_of, cut, window, run, size = (substring_dedup.word_units, substring_dedup.repeats_in_shard, 35, 6, 6.5) if operator == "op7" else (suffix_dedup.byte_units, suffix_dedup.repeats_in_shard, 200, 32, 1.0)
    bound = 3000
    monkeypatch.setattr(spans, "SHARD_BYTES", bound)

    def kernel(held, counts):
        if sum(map(len, held)) > 6 * bound:
            raise ValueError(f"{sum(map(len, held))} bytes in a shard")
        return cut(held, counts, window)

    docs = spark.createDataFrame(texts, "doc_id long, text string")
    packed, runs = spans.repeated_windows(docs, units_of, kernel, window, run, size, "doc_id", "text")
    found = spans.remove_repeats(docs, packed, runs, lambda text, ranges: (sum(b - a for a, b in ranges), str(ranges)), window, "n long, ranges string", "doc_id", "text")
    split = [t.split() if operator == "op7" else list(t.encode()) for _, t in texts]
    want = {}
    for (i, _), marks in zip(texts, covered(split, window)):
        edges = np.flatnonzero(np.diff([0, *marks, 0])).tolist()
        want[i] = (sum(marks), str(list(zip(edges[::2], edges[1::2]))))
    assert {r.doc_id: (r.n, r.ranges) for r in found.collect()} == want
    assert sum(n > 0 for n, _ in want.values()) >= 30


def test_deep_starts_equal_window_counts():
    rng = np.random.default_rng(3)
    for _ in range(30):
        texts = [rng.integers(0, 3, int(rng.integers(1, 30))) for _ in range(4)]
        places = rng.integers(1, 3, 4)
        sizes = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(4), sizes)
        place = np.arange(sizes.sum()) - (np.cumsum(sizes) - sizes)[owner]
        count = Counter()
        for t, n in zip(texts, places):
            for k in range(len(t) - 4):
                count[tuple(t[k : k + 5])] += n
        words = np.concatenate(texts).astype(np.uint64)
        got = set(substring_dedup.deep_starts(words, sizes[owner] - place, places[owner], 5).tolist())
        want = {p for p in range(len(words)) if sizes[owner[p]] - place[p] >= 5 and count[tuple(words[p : p + 5])] > 1}
        assert got == want


def sets_of(rows):
    out = []
    for i, t in data(rows):
        w = t.lower().split()
        out.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def brute_classes(sets):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(sets))]


def test_near_duplicates(docs, rows, empty):
    sets = sets_of(rows)
    want = Counter((i, len(s), c, i == c) for (i, s), c in zip(sets, brute_classes(sets)))
    assert taken(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r[c] for r in kept.collect() for c in CLASHES} == {"clash"}
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 2 not in ids and 3 not in ids and ids[20] == 1 and ids[None] == 2
    assert near_dedup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_a_large_group(spark):
    base = prose(11, 120).split()
    rng = np.random.default_rng(2)
    texts = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 5))):
            w[k] = f"new{rng.integers(0, 5)}"
        texts.append((i, " ".join(w)))
    sets = sets_of(texts)
    got = taken(near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")), "doc_id", "component_id")
    assert got == Counter((i, c) for (i, _), c in zip(sets, brute_classes(sets)))


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(f"{a:02d}", f"{b:02d}") for a, b in rng.integers(0, 60, (40, 2))] + [(f"{k:02d}", f"{k + 1:02d}") for k in range(60, 90)]
    root = {f"{k:02d}": f"{k:02d}" for k in range(95)}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    nodes = spark.createDataFrame([(k,) for k in root], "node string")
    got = {r.node: r.root for r in components(nodes, spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == root


def test_mix(docs, rows, empty):
    plan = curriculum.plan_mix(docs)
    out = plan.collect()
    assert len(out) == len(rows)
    total = sum(len((r[1] or "").split()) for r in rows)
    by_source = {}
    for r in out:
        by_source.setdefault(r.source, []).append(r)
    assert math.isclose(sum(rs[0].target for rs in by_source.values()), min(1.5 * total, 2 * total), rel_tol=1e-9)
    for rs in by_source.values():
        assert rs[0].target <= 2 * rs[0].source_size
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)
        assert all(r.taken <= 2 * r.size and r.taken == r.size * len(r.positions) for r in rs)
        assert all(0 <= p <= 1 for r in rs for p in r.positions)
    again = curriculum.plan_mix(docs.repartition(7))
    assert taken(again, "doc_id", "taken") == taken(plan, "doc_id", "taken")
    ordered = curriculum.in_training_order(docs)
    assert ordered.columns == docs.columns and ordered.count() == sum(len(r.positions) for r in out)
    assert curriculum.plan_mix(empty).count() == 0


def test_schedule_integral_is_inverted(spark):
    knots = curriculum.SCHEDULES
    shares = np.linspace(0, 1, 21)
    df = spark.createDataFrame([(float(u), r) for u in shares for r in range(3)], "u double, r int")
    for row in df.select("u", "r", curriculum._inverse_integral(F.col("u"), F.col("r"), knots).alias("t")).collect():
        xs, ws = zip(*knots[row.r])
        grid = np.linspace(0, row.t, 4001)
        whole = np.linspace(0, 1, 4001)
        area = np.trapezoid(np.interp(grid, xs, ws), grid) / np.trapezoid(np.interp(whole, xs, ws), whole)
        assert abs(area - row.u) < 1e-4


def test_token_store_round_trip(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    folder, dictionary = token_store.write_documents(docs, tokenizer_path(), file_bytes=20_000)
    got = sorted(token_store.read_documents(spark, folder, dictionary).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i or 0))
    want, start = Counter(), 0
    for i, t in data(rows):
        ids = np.array([*tokenizer.encode(t.decode(), add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    for r in got:
        assert r.start == start
        start += r.n_tokens
    # one document by the index of its file
    file = spark.read.format("binaryFile").load(f"{folder}/files").first()
    content = bytes(file.content)
    index = token_store.read_index(content)
    ids = token_store.read_ids(content, index[-1], dictionary)
    assert len(ids) == 4 * index[-1]["ids"]
    with pytest.raises(ValueError):
        token_store.read_ids(content, index[-1], dictionary + b"x")
    folder, dictionary = token_store.write_documents(empty, tokenizer_path())
    assert token_store.read_documents(spark, folder, dictionary).count() == 0


def test_a_second_process_reads_the_folder_alone(spark, docs, tmp_path):
    import json
    import os
    import subprocess
    import sys

    folder, _ = token_store.write_documents(docs, tokenizer_path(), folder=str(tmp_path / "store"))
    assert folder == f"file://{tmp_path}/store"
    want = sorted([r.n_tokens, r.ids_crc32] for r in token_store.read_documents(spark, folder).collect())
    code = (
        "import sys, json; from adjudica.session import local_session; from adjudica.llm import token_store; "
        "s = local_session(2); r = token_store.read_documents(s, sys.argv[1]).collect(); "
        "print('found', json.dumps(sorted([x.n_tokens, x.ids_crc32] for x in r)))"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "store")], cwd=root, capture_output=True, text=True, timeout=300)
    found = [line for line in out.stdout.splitlines() if line.startswith("found ")]
    assert found and json.loads(found[0][6:]) == want, out.stderr[-2000:]


def test_dictionary_of_long_texts(spark):
    long = [(i, prose(600 + i, 12_000)) for i in range(8)]
    assert all(len(t) > token_store.SAMPLE_BYTES for _, t in long)
    docs = spark.createDataFrame(long, "doc_id long, text string")
    dictionary = token_store.train_dictionary(docs, tokenizer_path(), 1, "doc_id", "text")
    assert 0 < len(dictionary) <= token_store.DICTIONARY_BYTES


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(tokenizer_path()), token_store.Encoder(tokenizer_path(), remembered=300)
    rng = np.random.default_rng(1)
    letters = list("ab'S<|>éÜ×ñ.,1²́  ΣKK\nİß")
    for _ in range(1500):
        text = "".join(rng.choice(letters, 40))
        assert encode(text.encode()) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    latin = [chr(c) for c in range(0x21, 0x180)]
    for text in [*latin, *["".join(rng.choice(latin, n)) for n in (2, 3, 5, 60) for _ in range(500)], "<|ENDOFTEXT|> x<|endoftext|>y <|endoftext|>"]:
        assert encode(text.encode()) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    words = ["".join(rng.choice(list("aeiíàéßÍÉz"), 6)) + str(rng.choice(["", ",", "?!", "'s"])) for _ in range(500)]
    assert encode(" ".join(words).encode()) == np.array(tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_in_blocks_equals_the_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "BLOCK_BYTES", 300)
    tokenizer, encode = Tokenizer.from_file(tokenizer_path()), token_store.Encoder(tokenizer_path(), remembered=40)
    words = ["The", "river's", "été", "ÉTÉ,", "straße!?", "x2", "<|endoftext|>", "a<|", "J\u030c", "\u00a0", "日本語", "\x00z", "don't", "(so)", "o" * 60, "***", "'"]
    rng = np.random.default_rng(3)
    texts = ["", "  \n", *(" ".join(rng.choice(words, n)) for n in (1, 3, 30, 5, 400, 8) for _ in range(12)), "q" * 1000, "end \t\x0b"]
    raw = [*(t.encode() for t in texts), b"caf\xe9, \xff\xfe ok\xc3 z" * 40]
    want = [np.array(tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for t in raw]
    assert list(encode.each(raw)) == want
    assert [encode(t) for t in raw[::-1]] == want[::-1]


def test_a_block_needs_one_call_for_all_its_new_words():
    class Counted:
        calls = 0

        def __init__(self, merges):
            self.merges = merges

        def encode_batch_fast(self, *args, **named):
            Counted.calls += 1
            return self.merges.encode_batch_fast(*args, **named)

    encode = token_store.Encoder(tokenizer_path())
    encode.merges = Counted(encode.merges)
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(rng.choice(list("aeinrsté"), 9)) + "," for _ in range(50)).encode() for _ in range(40)]
    first = list(encode.each(texts))
    assert Counted.calls == 1
    assert list(encode.each(texts)) == first and Counted.calls == 1  # remembered
    encode.forget()
    assert list(encode.each(texts)) == first and Counted.calls == 2


def test_language_id(spark, empty):
    rng = np.random.default_rng(0)
    words = {"en": "the of and thing river when other light", "de": "der und nicht schön über straße wenn auch", "fr": "le où été garçon avec très nous quand"}
    texts = [(i, " ".join(rng.choice(words[lang].split(), 1 + i % 12)), lang) for i, lang in enumerate(list(words) * 60)]
    texts += [(1000, None, "en"), (1001, "", "de"), (1002, "12 + 3!", "fr"), (1003, "the river", None), (None, "der und nicht auch", "de"), (1004, "the " * 20_000, "en")]
    df = spark.createDataFrame([t + ("x",) * 2 for t in texts], "doc_id long, text string, lang string, lang_pred string, _bytes string")
    got = {r.doc_id: r for r in language_id.fit_predict(df).collect()}
    held = [(i, lang) for i, t, lang in texts if t and lang and got[i].held_out and re.search("[a-z]", t)]
    assert len(held) > 20 and sum(got[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1003].lang_pred == "en" and got[None].lang_pred == "de" and got[1004].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.keep_identified(df)
    assert kept.columns == df.columns and not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}
    assert language_id.fit_predict(empty).count() == 0
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.fit_predict(unlabelled).collect()} == {"und"}


def test_language_of_long_texts_only(spark):
    rng = np.random.default_rng(10)
    words = {"en": "the of and thing river when other light", "de": "der und nicht schön über straße wenn auch", "fr": "le où été garçon avec très nous quand"}
    size = lambda lang, i: 4000 + i if lang == "fr" else 5 + i % 9
    texts = [(i, " ".join(rng.choice(words[lang].split(), size(lang, i))), lang) for i, lang in enumerate(list(words) * 25)]
    assert all(len(t.encode()) > 16_384 for _, t, lang in texts if lang == "fr")
    got = language_id.fit_predict(spark.createDataFrame(texts, "doc_id long, text string, lang string")).collect()
    right = Counter(r.lang_pred for r in got if r.lang_pred == texts[r.doc_id][2])
    assert right["fr"] == 25 and right["en"] >= 23 and right["de"] >= 23


def test_decontamination(spark, docs, empty):
    items = [(1, prose(21, 20)), (2, "what is " + prose(22, 12) + "? " + prose(23, 8)), (3, None), (4, ""), (5, prose(21, 20)), (None, prose(24, 30)), (6, "?!")]
    bench = spark.createDataFrame([i + ("x",) for i in items], "item_id long, text string, score string")
    leaks = [(100, prose(30, 90) + " " + items[0][1] + " " + prose(31, 200)), (101, items[1][1].upper()), (102, prose(32, 400) + " " + items[5][1]), (103, items[0][1].split()[0] + " " + prose(33, 300))]
    more = spark.createDataFrame([(i, t) for i, t in leaks], "doc_id long, text string")
    both = docs.unionByName(more, allowMissingColumns=True)
    found = decontaminate.find_leaks(both, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(100, 1), (100, 5), (101, 2), (102, None)}
    assert all(r.score > 0.99 for r in found)
    clean = decontaminate.without_leaks(both, bench)
    assert clean.columns == both.columns and clean.count() == both.count() - 3
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_short_questions_and_answers_are_found(spark):
    items = [(1, "which city lies on the seine below the old bridge? Paris"), (2, "who wrote the novel about the whale? Herman Melville"), (3, "why? because of rain")]
    items += [(10 + n, " ".join(f"short{n}word{k}" for k in range(n))) for n in range(1, 6)]
    texts = [(i, prose(40 + i, 80) + " " + t + " " + prose(70 + i, 80)) for i, t in items]
    bench, docs = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(texts, "doc_id long, text string")
    # the question alone is no leak of an item whose answer is missing
    alone = spark.createDataFrame([(200, items[0][1][:-5] + prose(39, 80)), (201, "short5word0 short5word1 short5word2")], docs.schema)
    found = decontaminate.find_leaks(docs.unionByName(alone), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i, _ in items}
    assert all(r.question_overlap == r.answer_overlap == 1.0 for r in found)
    assert [r.doc_id for r in decontaminate.without_leaks(docs.unionByName(alone), bench).orderBy("doc_id").collect()] == [200, 201]


def test_a_long_item_does_not_change_what_others_match(spark):
    short, long = (1, prose(51, 12)), (2, prose(52, 1500, 3000))
    words = short[1].split()
    # the short item's words lie scattered, in runs of three, over a clean text
    scattered = " ".join(" ".join(words[k : k + 3]) + " " + " ".join(f"gap{k}x{j}" for j in range(300)) for k in range(0, 12, 3))
    docs = spark.createDataFrame([(1, scattered), (2, prose(53, 700) + " " + short[1] + " " + prose(54, 90)), (3, prose(55, 500) + " " + long[1])], "doc_id long, text string")
    alone, both = (spark.createDataFrame(items, "item_id long, text string") for items in ([short], [short, long]))
    found = lambda bench: {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found(alone) == {(2, 1)} and found(both) == {(2, 1), (3, 2)}
    assert [r.doc_id for r in decontaminate.without_leaks(docs, both).collect()] == [1]


def test_block_max_wand_equals_scoring_everything():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{int(x)}".encode() for x in rng.zipf(1.3, 4000) if x < 500]
    items = [(k, b" ".join(rng.choice(vocabulary, int(rng.integers(3, 20))))) for k in range(300)]
    df = Counter(w for _, t in items for w in set(t.split()))
    mean = sum(len(t.split()) for _, t in items) / len(items)
    index = decontaminate.BlockMaxIndex(items, df, len(items), mean, dict(df), 0.4)
    hits = 0
    for _ in range(200):
        words = set(rng.choice(vocabulary, 40)) | set(items[int(rng.integers(0, 300))][1].split()[:6])
        scores: Counter = Counter()
        for w in words:
            if w in index.lists:
                for item, weight in zip(index.lists[w].items, index.lists[w].weights):
                    scores[item] += weight
        want = {i for i, s in scores.items() if s >= index.threshold}
        got = index.search(words)
        assert {i for i, _ in got} == want and len(got) == len(want)
        assert not want or index.may_hold(words)
        hits += len(want)
    assert hits > 200


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((3000, 24))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows[7] = (7, rows[6][1])
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0] * 23 + [None]), (5080, [1.0, 2.0]), (None, [1.0] * 24), (5100, [])]
    df = spark.createDataFrame([r + ("x", "y") for r in rows + odd], "vec_id long, embedding array<double>, block string, queries string")
    got: dict = {}
    for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    data_ = np.array([r[1] for r in rows])
    assert sorted(got) == list(range(0, 3000, 20))
    recall = []
    for q, found in got.items():
        scores = data_ @ data_[q]
        scores[q] = -np.inf
        assert [k for k, _, _ in found] == list(range(1, 21))
        assert all(math.isclose(scores[v], s, rel_tol=1e-12, abs_tol=1e-12) for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        recall.append(len({v for _, v, _ in found} & set(np.lexsort((np.arange(3000), -scores))[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9
    few = collision_ann.nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert collision_ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_neighbours_of_repeated_rows_and_several_dimensions(spark):
    """Small tables are verified whole: the ranking equals brute force, row by row."""
    rng = np.random.default_rng(26)
    rows = [(i, rng.standard_normal(3 + i % 3).tolist()) for i in range(0, 60, 5)]
    rows += [rows[0], rows[4], rows[4], (20, rng.standard_normal(3).tolist()), (40, rows[8][1])]
    df = spark.createDataFrame([r + (1, "x") for r in rows], "vec_id long, embedding array<double>, row int, dim string").repartition(4)
    found = Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0, 5).collect())
    want: Counter = Counter()
    for a, (query, q) in enumerate(rows):
        if query % 20 == 0:
            scored = sorted((-float(np.dot(v, q)), i) for b, (i, v) in enumerate(rows) if b != a and len(v) == len(q))
            want.update((query, k, i, round(-s, 9)) for k, (s, i) in enumerate(scored[:5], 1))
    assert found == want and max(want.values()) > 1


@pytest.mark.parametrize("norms", ["one outlier", "lognormal"])
def test_nearest_neighbours_of_uneven_norms(spark, norms):
    rng = np.random.default_rng(16)
    vectors = rng.standard_normal((2000, 64))
    vectors /= np.sqrt((vectors * vectors).sum(1))[:, None]
    if norms == "one outlier":
        vectors[17] *= 3
    else:
        vectors *= np.exp(rng.normal(0, 0.6, 2000))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in collision_ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in range(0, 2000, 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        recall.append(len(got[q] & set(np.argsort(-scores, kind="stable")[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9, np.mean(recall)


def test_norm_blocks_hold_every_class():
    assert collision_ann.norm_blocks({5: 3, 0: 1, 9: 20_000, 2: 15, 7: 10, 12: 2}, 20) == [(0, 0, 1), (2, 0, 1), (5, 0, 1), (7, 1, 1), (9, 2, 3), (12, 5, 1)]
    assert collision_ann.norm_blocks({}, 20) == []
