import collections
import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxalith.llm import graph, jaccard, licenses, lines, lm, media, mixing, packing, quality, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string"
LONG = " ".join(f"w{i}" for i in range(30_000))


def docs(spark, texts, sources=None):
    sources = sources or ["a", None, "b"]
    return spark.createDataFrame([(i, t, "en", sources[i % len(sources)], len(t or ""), 0.5, "x") for i, t in enumerate(texts)], DOCS)


TEXTS = [None, "", "one", "b c d e", LONG, "same words go here again", "same words go here again", "line one\n\nline two\nline one", "ünï cödé " * 9, "\n\n \n"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a very long text, repeated texts, a repeated row, a null id, clashing column names."""
    df = docs(spark, TEXTS)
    return df.unionByName(df.filter("doc_id = 5")).unionByName(df.filter("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))


def test_media_round_trip(spark, odd):
    rng = random.Random(1)
    for n in (0, 1, 64, 1025, 8193, 140_000):
        payload, size = media.payload_of("é" * n)
        stored = media.mux(payload)
        got = media.parse(stored)
        assert got.complete and media.samples(stored, got) == payload and size == 2 * n
        assert all(stored[c.cluster_offset : c.cluster_offset + 4] == b"\x1f\x43\xb6\x75" for c in got.cues)
        cut = media.parse(stored[: rng.randrange(len(stored))])
        assert not cut.complete or not cut.packets or n == 0
    assert not media.parse(b"junk").packets and not media.parse(None).complete
    rows = media.document_media(odd).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        raw = (TEXTS[r.doc_id if r.doc_id is not None else 3] or "").encode()
        padded = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
    assert media.packet_table(media.as_media(odd)).filter("doc_id = 4").count() == -(-rows[4].payload_bytes // 1024)
    assert media.document_media(odd.limit(0)).count() == 0


def test_unknown_sizes_and_block_groups():
    body = media.unsigned(media.CLUSTER_TIMESTAMP, 7) + media.element(media.BLOCK_GROUP, media.element(media.BLOCK, media.block(2, 1, [memoryview(b"ab"), memoryview(b"cde")], media.XIPH)) + media.unsigned(media.REFERENCE_BLOCK, 1))
    cluster = media.CLUSTER.to_bytes(4, "big") + b"\xff" + body
    got = media.parse(media.SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + cluster + cluster)
    assert got.complete and got.clusters == 2 and [(p.track, p.timestamp_ns, p.keyframe, p.length) for p in got.packets[:2]] == [(2, 8_000_000, False, 2), (2, 8_000_000, False, 3)]


def test_damaged_media_numbers(spark):
    stored = media.mux(b"x" * 4096)
    at = stored.index(bytes([0x44, 0x89])) + 3
    for odd in ("nan", "inf", "1e300"):
        got = media.parse(stored[:at] + struct.pack(">d", float(odd)) + stored[at + 8 :])
        assert not got.complete and got.duration_ns == 0
    cluster = media.element(media.CLUSTER, media.unsigned(media.CLUSTER_TIMESTAMP, 1) + media.element(media.SIMPLE_BLOCK, media.block(1, 0, [memoryview(b"ab")], 0)))
    late = media.element(media.CLUSTER, media.unsigned(media.CLUSTER_TIMESTAMP, (1 << 64) - 1) + media.element(media.SIMPLE_BLOCK, media.block(1, 0, [memoryview(b"ab")], 0)))
    df = spark.createDataFrame([(1, bytearray(media.element(media.SEGMENT, cluster + late)))], "n long, media binary")
    rows = media.packet_table(df, key="n").collect()
    assert [(r.n, r._n, r.timestamp_ns) for r in rows] == [(1, 0, 1_000_000)]
    assert media.media_features(media.as_media(docs(spark, TEXTS))).exceptAll(media.document_media(docs(spark, TEXTS))).count() == 0


def test_toxicity_learns_stems():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghilmnorst") for _ in range(rng.randrange(3, 8)))
    make = lambda bad: " ".join([word() for _ in range(60)] + ["vileword" + word()[:2]] * bad)
    texts, labels = [make(i % 2) for i in range(400)], [i % 2 for i in range(400)]
    model = toxicity.train(texts[:300], labels[:300])
    got = [s >= 0.7 for s in toxicity.Scorer(model)(texts[300:])]
    assert np.mean(np.array(got) == np.array(labels[300:])) > 0.95
    assert toxicity.Scorer(model)([None, ""]) == [pytest.approx(toxicity.Scorer(model)([""])[0])] * 2
    assert 0 < toxicity.Scorer(toxicity.train([], []))(["x"])[0] < 1


def test_quality_learns_shapes(spark, odd):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    good, bad = [" ".join(word() for _ in range(40)) for _ in range(60)], [" ".join(word().upper() + "!!" for _ in range(40)) for _ in range(60)]
    model = quality.train(good[:40] + bad[:40], [1] * 40 + [0] * 40)
    score = quality.Scorer(model)
    assert all(score(t) > 0.5 for t in good[40:]) and all(score(t) < 0.5 for t in bad[40:])
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(TEXTS) + 2 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    labels = spark.createDataFrame([(0, None, 1), (None, 1, 0), (2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.score(odd, quality.fit(odd, labels)).count() == len(TEXTS) + 2
    assert toxicity.score(odd, toxicity.fit(odd, labels)).count() == len(TEXTS) + 2
    assert toxicity.without_toxic(odd, labels).columns == odd.columns


def test_quality_reads_unspaced_texts_whole():
    rng = random.Random(13)
    low = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    code = lambda bad: ",".join([low(5) for _ in range(15)] + [low(5).upper() + "!!" if bad else low(5) for _ in range(40)])
    han = lambda bad: "".join(rng.choice("的一是了我不人在他有") for _ in range(80)) + "".join(rng.choice("鑫囍龘靐" if bad else "的一是了") for _ in range(80))
    for make in (code, han):
        texts, labels = [make(i % 2) for i in range(120)], [1 - i % 2 for i in range(120)]
        score = quality.Scorer(quality.train(texts[:80], labels[:80]))
        assert [score(t) > 0.5 for t in texts[80:]] == [x == 1 for x in labels[80:]]
    assert quality.shape("a-b-c-d-e-F0") == "a-a-a-a-a-A0"
    for t in ("x" * 500 + "Q9_" * 90, "ünï" * 300, "他们 abc的def " * 3, "__!!??" * 40):
        assert "".join(quality.words_of(t)) == "".join(t.split())


def test_packing_is_whole_and_gapless(spark, odd):
    from tokenizers import Tokenizer

    rows = packing.packed(odd).collect()
    plain = Tokenizer.from_file(packing.tokenizer_path())
    n = {i: len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(TEXTS)}
    own = collections.defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
    for i, size in n.items():
        assert sum(r.length for r in own[i]) == size * (2 if i == 5 else 1)
    first = sorted(own[4], key=lambda r: r.piece)
    assert [r.length for r in first[1:]] == [2048] * (len(first) - 1) and first[0].length == (n[4] % 2048 or 2048)
    ids = [*plain.encode(TEXTS[3], add_special_tokens=False).ids, 0]
    assert own[3][0].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_packing_plan_is_near_the_bound():
    rng = random.Random(5)
    counts = collections.Counter(min(2048, int(rng.lognormvariate(6.3, 0.9)) + 1) for _ in range(5000))
    places, bins = packing.planned(counts)
    assert sum(p.n for p in places) == 5000 and bins <= 1.02 * -(-sum(k * v for k, v in counts.items()) // 2048) + 1
    assert packing.planned({}) == ([], 0)


def test_encoder_equals_the_tokenizer():
    e = packing.Encoder(packing.tokenizer_path())
    e.fast and [e.encode(f"probe{i}") for i in range(packing.PROBE)]
    for t in ["see <|endoftext|> now", "<|endoftext|><|endoftext|>", "it's a test, yes.\nAnd more", "a  b", " x\n\n y", "ünï. cödé, 12 3.4", "a　b c", "<|endoftext|> x", "end. ", "don't, won't."]:
        assert e([t])[0] == np.asarray(e.defined(t), "<u4").tobytes(), t


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(300, 10)).round(1)
    v[100:160] = v[0]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(400, None), (450, [1.0, None]), (500, [float("nan")] * 10), (550, []), (None, [1.0] * 10)]
    got = collections.defaultdict(list)
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    x = np.floor(256 * v).astype(int)
    for q in range(0, 300, 50):
        want = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]
    assert set(got) == set(range(0, 300, 50))
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_top_k_phases(spark):
    """The keyed way equals the broadcast one, scores beyond 2**53 are exact, and phase 2 collects what its cutoff says."""
    rng = np.random.default_rng(16)
    big = rng.integers(-(1 << 29), 1 << 29, size=(120, 3)) / 256
    v = rng.normal(size=(2300, 8)).round(2)
    for x, base in ((v, 0), (big, 10_000)):
        df = spark.createDataFrame([(i + base, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
        ints = [[math.floor(y * 256) for y in r] for r in x.tolist()]
        score = lambda a, b: sum(p * q for p, q in zip(ints[a], ints[b]))
        want = {(q + base, k + 1, i + base, -s) for q in range(0, len(x), 50) for k, (s, i) in enumerate(sorted((-score(q, i), i) for i in range(len(x)) if i != q)[:5])}
        for sent in (topk.SENT, 0):
            assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, sent=sent).collect()} == want
        fifth = {q: s for q, k, _, s in want if k == 5}
        least = sum(2 * score(q, i) >= 0 and any(2 * sum(ints[q][j] * ints[i][j] for j in part) >= fifth[q + base] for part in (range(len(ints[0]) // 2), range(len(ints[0]) // 2, len(ints[0])))) for q in range(0, len(x), 50) for i in range(len(x)) if i != q)
        entries = topk.phases(df)[0]
        got = entries.select("q_block", "q_place", "block", "place").distinct().count()
        assert least <= got < len(x) * len(range(0, len(x), 50)) * 0.6


def test_top_k_of_few_components_and_negative_scores(spark):
    for dim in (1, 2, 3):
        rows = [(0, [1.0] * dim)] + [(i, [-float(1 + (i * (j + 3)) % 7) for j in range(dim)]) for i in range(1, 12)]
        got = sorted((r["rank"], r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
        want = sorted((-int(256 * 256 * sum(v)), i) for i, v in rows[1:])[:5]
        assert got == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]


def test_mixing_meets_targets(spark, odd):
    assert mixing.fill([10, 100, 100], [5, 2, 1], 315, 2) == [20, 196.66666666666666, 98.33333333333333]
    rng = random.Random(7)
    df = docs(spark, [" ".join(["w"] * rng.randrange(1, 60)) for _ in range(400)], ["a", "b", None, "c", "a"])
    plan = lambda d: mixing.planned(x := mixing.sized(d), x)
    rows = plan(df.drop("size")).collect()
    assert rows[0].asDict()["size"] is not None and len(rows) == 400
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1 and all(0 <= r.taken <= 2 * r["size"] for r in own)
        assert sum(r["size"] for r in own) == own[0].source_size
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * sum(r["size"] for r in rows)) < 1e-6
    assert sorted(map(str, rows)) == sorted(map(str, plan(df.drop("size").repartition(7)).collect()))
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == sum(r.taken for r in rows)
    assert plan(odd.drop("size")).count() == len(TEXTS) + 2 and mixing.mixed(odd.limit(0)).count() == 0
    clash = df.withColumns({c: F.lit("mine") for c in ("size", "target", "taken", "place", "row", "copy", "source_size")})
    got = mixing.mixed(clash)
    assert got.columns == clash.columns and {r["size"] for r in got.collect()} == {r["row"] for r in got.collect()} == {"mine"}


def test_lm_equals_counts(spark, odd):
    rows = lm.lm_scores(odd).collect()
    train = collections.Counter()
    for r in rows:
        if not r.held_out:
            train.update(lm.words_of(TEXTS[r.doc_id if r.doc_id is not None else 3] or "") + [b""])
    n, v = sum(train.values()), len(train)
    for r in rows:
        tokens = lm.words_of(TEXTS[r.doc_id if r.doc_id is not None else 3] or "") + [b""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(train[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
        assert r.score < 0
    assert lm.lm_scores(odd.limit(0)).count() == 0


def test_license_scan(spark, odd):
    index = licenses.build()
    mit = licenses.TEMPLATES["mit"][0]
    got = licenses.scan("x y z " + mit.upper() + " tail", index)
    assert got.labels == ["mit"] and got.score > 0.9 and got.matches[0][1] in range(3, 10)
    assert licenses.scan(mit.replace("hereby granted", "not granted"), index).labels == []
    both = licenses.scan("CC-BY text under cc by and the General Public License; CC  BY", index)
    assert (both.n_base, both.first_word, both.last_word, both.base_labels) == (4, 0, 11, ["cc-by", "gpl"])
    assert licenses.scan(None, index) == licenses.scan("", index) and licenses.scan("", index).score == 0
    assert licenses.license_scan(odd).count() == len(TEXTS) + 2


def test_license_lines_fire():
    index = licenses.build()
    want = {"Released under the MIT License.": ["mit"], "Licensed under the Apache License, Version 2.0.": ["apache-2.0"], "This work is licensed under the GNU General Public License, version 3.": ["gpl", "gpl-3.0"], "Licensed under CC BY-NC 4.0.": ["cc-by", "cc-by-nc"], "an apache version of the license 2 0": [], "released under the sea": [], "cc by hand": ["cc-by"]}
    for text, labels in want.items():
        for filler in ("", "some other words here\n" * 50):
            assert licenses.scan(f"{filler}{text}\nmore", index).labels == labels, text


def test_license_scan_of_many_notices():
    index = licenses.build()
    names = sorted(licenses.TEMPLATES)
    own = {n: licenses.TEMPLATES[n][0] for n in names}
    for some in [*itertools.combinations(names, 3), names]:
        got = licenses.scan("\n".join(own[n] for n in some), index)
        assert {m[0] for m in got.matches} >= set(some), some
    vocabulary = b" ".join(sorted(index.postings)).decode()
    assert all(n in licenses.scan(vocabulary + "\n" + own[n], index).labels for n in names)


def test_jaccard_join_equals_brute_force(spark, odd):
    rng = random.Random(8)
    base = [[f"t{rng.randrange(4000)}" for _ in range(rng.randrange(20, 120))] for _ in range(25)]
    texts = []
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += ["", "a b", "A  b", "a b c d e", None]
    sets = [frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for t in texts]
    least = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and least[i] != least[j]:
                    least[i] = least[j] = min(least[i], least[j])
                    changed = True
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.linked(docs(spark, texts)).collect()}
    assert got == {i: (len(s), least[i]) for i, s in enumerate(sets)}
    assert jaccard.linked(odd).count() == len(TEXTS) + 2 and jaccard.one_of_each(odd).columns
    assert jaccard.linked(odd.limit(0)).count() == 0


def test_line_dedup(spark, odd):
    rng = random.Random(9)
    lines_ = [" ".join(f"word{rng.randrange(9999)}" for _ in range(60)) for _ in range(30)]
    near = [x.replace(x.split()[7], "other") for x in lines_[:10]]
    texts = ["\n".join(lines_[i * 3 : i * 3 + 3]) for i in range(10)] + ["\n".join([*near, "own closing line"])]
    df = docs(spark, texts)
    rows = lines.line_classes(df).collect()
    gone = [(r.doc_id, r.line_no) for r in rows if not r.keep]
    assert sorted(gone) == [(10, i) for i in range(10)]
    assert all((r.kept_doc_id, r.kept_line_no) == (r.line_no // 3, r.line_no % 3) for r in rows if not r.keep)
    kept = {r.doc_id: r.text for r in lines.without_repeats(df).collect()}
    assert kept[10] == "own closing line" and kept[0] == texts[0] and len(kept) == 11
    out = lines.without_repeats(odd)
    assert out.columns == odd.columns and {r.doc_id for r in out.filter("text is null or text = ''").collect()} == {0, 1}
    assert lines.without_repeats(odd.limit(0)).count() == 0


def kept_lines(spark, texts):
    return [r.keep for r in sorted(lines.line_classes(docs(spark, texts)).collect(), key=lambda r: (r.doc_id, r.line_no))]


def test_line_shingles_hold_every_character(spark):
    urls = ["please read all of the terms at https://example.com/" + x for x in ("licenses/2023/apache", "privacy/about/us/xyz")]
    commits = ["commit 0123456789ab" + x * 4 for x in ("cdef012", "9876543")]
    assert kept_lines(spark, urls) == [True, True] and kept_lines(spark, commits) == [True, True]
    sets = spark.createDataFrame([("a\U0001f600bcdefghijklé",), ("short",), ("é" * 12,), ("ab" * 40,)], "line string").select(lines.shingles(F.col("line")).alias("s"))
    assert [len(set(r.s)) for r in sets.collect()] == [3, 1, 1, 2]


def test_line_shingles_are_one_definition(spark):
    rng = random.Random(12)
    line = " ".join("".join(rng.choice("abcdefghij") for _ in range(11)) for _ in range(60))
    assert len(line) == 719 and kept_lines(spark, [line, line + "xy"]) == [True, False]


def character_shingles(line):
    line = line.lower().strip(" \t\r\x0b\x0c")
    return {line[i : i + lines.WIDTH] for i in range(max(1, len(line) - lines.WIDTH + 1))}


def test_band_keys_slice_outside_lambdas(spark):
    plan = lines.signatures(lines.split_lines(docs(spark, ["a line of text that is long enough"])))._jdf.queryExecution().analyzed().toString()
    assert "slice(_m" in plan
    for part in plan.split("lambdafunction(")[1:]:
        depth, end = 1, 0
        while depth and end < len(part):
            depth += {"(": 1, ")": -1}.get(part[end], 0)
            end += 1
        assert "slice(" not in part[:end]


def lambdas(plan):
    """What stands within the lambdas of a printed plan."""
    for part in plan.split("lambdafunction(")[1:]:
        depth, end = 1, 0
        while depth and end < len(part):
            depth += {"(": 1, ")": -1}.get(part[end], 0)
            end += 1
        yield part[:end]


def test_line_steps_are_done_once_and_compiled(spark):
    """A document is hashed once, not for each of its lines; sets meet outside lambdas; parities make no row of a shingle."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    split = plan(lines.split_lines(docs(spark, ["a\nb"])))
    assert re.search(r"Generate explode|Generate posexplode", split).start() < re.search(r"xxhash64\((coalesce\()?_?text", split).start()
    texts = spark.createDataFrame([(1, "a line of text"), (2, "b line of text")], "h long, line string")
    pairs = spark.createDataFrame([(1, 2, 6)], "a long, b long, sizes long")
    met = plan(lines.verified(pairs, texts, 80))
    assert "array_intersect(" in met and not any("array_intersect(" in part for part in lambdas(met))
    assert "Generate" not in plan(lines.with_parities(texts))


def test_line_parities(spark):
    """Sizes are exact and no two sets differ in more bits than shingles."""
    rng = random.Random(3)
    texts = ["", "x", "ab" * 40, "\U0001f600" * 13, *("".join(rng.choice("abc d") for _ in range(rng.randrange(5, 2000))) for _ in range(20))]
    texts += [t + " more" for t in texts] + [t[:90] + "-" + t[90:] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "h long, line string")
    got = {r.h: r for r in lines.with_parities(df).collect()}
    sets = [{t[i : i + lines.WIDTH] for i in range(max(1, len(t) - lines.WIDTH + 1))} for t in texts]
    assert [got[i].n for i in range(len(texts))] == [len(s) for s in sets]
    bits = [[got[i][c] % 2**64 for c in lines.PARITIES] for i in range(len(texts))]
    for i in range(len(texts)):
        assert sum(w.bit_count() for w in bits[i]) % 2 == len(sets[i]) % 2
        for j in range(i):
            flipped = sum((x ^ y).bit_count() for x, y in zip(bits[i], bits[j]))
            assert flipped <= len(sets[i] ^ sets[j]) and (flipped - len(sets[i] ^ sets[j])) % 2 == 0


def test_line_blanks(spark):
    """White space at a line's ends doesn't count, whichever it is and at which end, and blank lines are no lines."""
    ends = ["", " ", "\t", "\r", "\x0b", "\x0c", " \t \x0c", "\u00a0"]
    raw = [x + middle + y for middle in ("", "One Line", "\u00c9t\u00e9 A") for x in ends for y in ends]
    rows = lines.split_lines(docs(spark, ["\n".join(raw)])).collect()
    want = {i: t.strip(" \t\r\x0b\x0c").lower() for i, t in enumerate(raw)}
    assert {r.line_no: (r.line, r.n_chars) for r in rows} == {i: (t, len(t)) for i, t in want.items() if t}


def test_line_recall_by_length(spark):
    """Of planted pairs that are similar enough by all their shingles, nine in ten meet at every length; no other pair does."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    texts, groups = [], []
    for bucket, (least, most) in enumerate(((20, 60), (60, 120), (120, 300), (300, 900))):
        while groups.count(bucket) < 120:
            size, line = rng.randrange(least, most), ""
            while len(line) < size:
                line += word() + " "
            line, at = line.strip(), rng.randrange(10)
            copy = line + word() if at < 4 else word() + line if at < 6 else line[: (k := rng.randrange(len(line)))] + word() + line[k:]
            a, b = character_shingles(line), character_shingles(copy)
            if 100 * len(a & b) >= 80 * len(a | b):
                texts += [line, copy]
                groups.append(bucket)
    for _ in range(100):
        line = " ".join(word() for _ in range(30))
        texts += [line, line[: len(line) // 2] + " " + " ".join(word() for _ in range(15))]
    rows = {r.doc_id: r for r in lines.line_classes(docs(spark, texts)).collect()}
    met = [not rows[2 * i + 1].keep and rows[2 * i + 1].kept_doc_id == 2 * i for i in range(len(texts) // 2)]
    for bucket in range(4):
        share = np.mean([m for m, g in zip(met, groups) if g == bucket])
        assert share >= 0.9, (bucket, share)
    assert not any(met[len(groups) :])


def test_lm_equals_a_plain_model(spark):
    """The model's scores against one with exact EM, without a grid; probabilities of a context sum to 1."""
    rng = random.Random(22)
    texts = [" ".join(rng.choice(["a", "b", "c", "d e", "f g h"]) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    rows = {r.doc_id: r for r in lm.lm_scores(docs(spark, texts)).collect()}
    tokens = {i: [b"", *lm.words_of(t), b""] for i, t in enumerate(texts)}
    uni, bi, context = collections.Counter(), collections.Counter(), collections.Counter()
    for i, ts in tokens.items():
        if not rows[i].held_out:
            uni.update(ts[1:])
            bi.update(zip(ts, ts[1:]))
    total, kinds = sum(uni.values()), len(uni)
    bucket = lambda c: 0 if c <= 0 else 1 + int(math.log2(c))
    cells = collections.defaultdict(list)
    for (h, w), n in bi.items():
        ch = uni[h] - 1
        cells[bucket(ch)].append((n, (n - 1) / ch if ch else 0, (uni[w] - 1) / (total - 1)))
    mix = {}
    for b, own in cells.items():
        n, p2, p1 = map(np.array, zip(*own))
        weight, parts = np.array([1 / 3] * 3) if b else np.array([0, 0.5, 0.5]), np.stack([p2, p1, np.full(len(n), 1 / (kinds + 1))])
        for _ in range(lm.ROUNDS):
            share = weight[:, None] * parts
            weight = (share / share.sum(0) * n).sum(1) / n.sum()
        mix[b] = weight
    p = lambda h, w: mix[bucket(uni[h])] @ [bi[h, w] / uni[h], uni[w] / total, 1 / (kinds + 1)]
    for i, ts in tokens.items():
        want = sum(math.log10(p(h, w)) for h, w in zip(ts, ts[1:]))
        assert rows[i].score == pytest.approx(want, rel=0.02, abs=0.02)
    assert sum(p(b"a", w) for w in uni) + mix[bucket(uni[b"a"])][2] / (kinds + 1) == pytest.approx(1)


def test_jaccard_stage_tells_rows_apart(spark):
    words = [f"w{i}" for i in range(60)]
    near, other = " ".join([*words[:-1], "end"]), " ".join(f"x{i}" for i in range(60))
    rows = [(1, " ".join(words)), (5, near), (5, other), (7, "same row here now ok"), (7, "same row here now ok"), (7, "same row here now ok"), (None, near)]
    df = spark.createDataFrame([(i, t, f"k{n}", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, key string, many long")
    out = jaccard.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text[:2]) for r in out.collect()) == [(0, "w0"), (1, "w0"), (5, "x0"), (7, "sa")]


def test_line_stage_keeps_any_columns(spark):
    line = "a line of text that is long enough to be compared with others here"
    df = spark.createDataFrame([(1, f"{line}\nown", "x", 1), (2, f"{line}\n\t\nrest", "y", 2), (None, line, "z", 3)], "doc_id long, text string, doc string, gone long")
    got = {r.doc_id: (r.text, r.doc, r.gone) for r in lines.without_repeats(df).collect()}
    assert got == {1: (f"{line}\nown", "x", 1), 2: ("\t\nrest", "y", 2)}


def test_components(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k in root} == root
