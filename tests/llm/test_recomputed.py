"""Language posteriors, classifier scores and the rows of every pipeline stage, recomputed by plain loops."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from velostat.llm import classifier, language
from velostat.llm.queries import TOKENIZER

WORD = r"[^\x20\x09-\x0D]+"
M64 = (1 << 64) - 1


# --- language ---------------------------------------------------------------


def trigrams(text):
    """Buckets of the byte trigrams with a letter in the middle."""
    fold = lambda b: b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
    x = [fold(b) for b in (text or "").encode()]
    codes = [x[i] << 16 | x[i + 1] << 8 | x[i + 2] for i in range(len(x) - 2) if x[i + 1] != 32]
    return Counter((c * 2654435761 % (1 << 32)) >> 18 for c in codes)


def units(counts):
    total = sum(counts.values())
    return {b: round(c / (1 + total / language.FULL) * language.UNIT) / language.UNIT for b, c in counts.items()}


def plain_identify(rows, labelled):
    """(lang, confidence, vote) of rows (text, host, domain, suffix, declared)."""
    sample = sorted({(t, x) for t, x in labelled if t is not None and x is not None})
    names = sorted({x for _, x in sample})
    size, even = len(names), 1 / language.BUCKETS
    model = {x: Counter() for x in names}
    for t, x in sample:
        model[x].update(units(trigrams(t)))

    def likelihoods(text):
        counts = trigrams(text)
        n = sum(counts.values())
        left = {x: Counter(model[x]) for x in names}
        if n:
            for t, x in sample:
                if t == text:
                    left[x].subtract(units(counts))
        total = {x: sum(left[x].values()) for x in names}
        sums = [0.0] * (size + 2)
        for b, c in counts.items():
            p = [(left[x][b] + language.SMOOTHING) / (total[x] + language.SMOOTHING * language.BUCKETS) for x in names]
            for i, v in enumerate([*p, (sum(p) / size + even) / 2, even]):
                sums[i] += c * math.log(v)
        sums = [s / (1 + n / language.FULL) for s in sums]
        out = sums[:size] + [max(sums[size:]) + math.log(language.UNKNOWN / (1 - language.UNKNOWN))]
        best = max(range(size + 1), key=lambda i: (out[i], -i))
        return out, None if not n or best == size else best

    found = [likelihoods(r[0]) for r in rows]
    whole = Counter(v for _, v in found if v is not None)
    votes = [Counter((r[1 + k], v) for r, (_, v) in zip(rows, found) if v is not None) for k in range(4)]
    out = []
    for r, (like, vote) in zip(rows, found):
        own = [int(i == vote) for i in range(size)]
        every = [max(whole[i] - own[i], 0) for i in range(size)]
        share = [(n + 1) / (sum(every) + size) for n in every]

        def smoothed(k, towards):
            m = [max(votes[k][r[1 + k], i] - own[i], 0) for i in range(size)]
            return [(n + language.PRIOR_WEIGHT * t) / (sum(m) + language.PRIOR_WEIGHT) for n, t in zip(m, towards)]

        prior = smoothed(0, smoothed(1, share))
        suffix, declared = smoothed(2, share), smoothed(3, share)
        e = [math.log(prior[i]) + like[i] + math.log(suffix[i] / share[i]) + math.log(declared[i] / share[i]) for i in range(size)] + [like[size]]
        p = [math.exp(x - max(e)) for x in e]
        best = max(range(size), key=lambda i: (p[i], -i))
        out.append((names[best], p[best] / sum(p), None if vote is None else names[vote]))
    return out


EN = ["the cat and the dog run over the old bridge", "this is a short text about water and bread", "we read the book and went home"]
DE = ["der hund und die katze gehen über die alte brücke", "das ist ein kurzer text über wasser und brot", "wir lasen das buch und gingen nach hause"]


def test_posteriors(spark):
    labelled = [(f"{t} {k}", x) for k in range(4) for ts, x in ((EN, "en"), (DE, "de")) for t in ts] + [(None, "en"), ("x", None), (EN[0], "fr"), ("", "en")]
    rows = [(f"{t} {k % 5}", f"h{k % 3}", f"d{k % 2}", ["com", "de", None][k % 3], [None, "en", "de"][k % 3]) for k in range(6) for t in EN + DE]
    rows += [("xq zzkw pfgh jjj", "h1", "d1", "com", "en"), (None, "h0", None, "de", None), ("", None, None, None, None), ("123 !!", "new", "new", "new", "xx"), (EN[0], "h2", "d0", None, "en")]
    frame = spark.createDataFrame([(i, i, *r) for i, r in enumerate(rows)], "id bigint, key bigint, text string, host string, domain string, suffix string, declared string")
    got = {r.id: r for r in language.identify(frame, spark.createDataFrame(labelled, "text string, lang string")).collect()}
    for i, (lang, confidence, vote) in enumerate(plain_identify(rows, labelled)):
        assert (got[i].lang, got[i].text_lang) == (lang, vote), rows[i]
        assert got[i].confidence == pytest.approx(confidence, rel=1e-6), rows[i]


# --- classifier -------------------------------------------------------------


def mix(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & M64
    h = (h ^ h >> 27) * 0x94D049BB133111EB & M64
    return h ^ h >> 31


def plain_features(text, buckets):
    values = np.random.default_rng(classifier._SEED).integers(1, 1 << 64, 256, dtype=np.uint64).tolist()
    base = classifier._BASE | 1
    poly = lambda raw: sum(values[b] * pow(base, i, 1 << 64) for i, b in enumerate(raw)) & M64
    data = re.sub(rb"[\x09-\x0D]", b" ", (text or "").encode()) + b" "
    words = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", data)]
    out = [mix(poly(data[a:b])) for a, b in words]
    for n in classifier.GRAMS:
        out += [mix((poly(data[i : i + n]) + n) & M64) for a, b in words for i in range(a, b + 2 - n)]
    out = [h & buckets - 1 for h in out]
    for n in classifier.AGAIN:
        grams = [data[words[i][0] : words[i + n - 1][1]] for i in range(len(words) - n + 1)]
        out += [mix(classifier._SEED + n) & buckets - 1] * (len(grams) - len(set(grams)))
    return out


def test_scores(spark, hard_docs):
    buckets = 1 << 10
    model = np.random.default_rng(3).normal(size=buckets + 1).astype(np.float32)
    docs = hard_docs.where("length(text) < 2000 or text is null")
    got = sorted((str(r.doc_id), round(r.score, 9)) for r in classifier.score(docs, model).collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        found = plain_features(r.text, buckets)
        z = sum(float(model[f]) for f in found) / max(1, len(found)) + float(model[-1])
        want.append((str(r.doc_id), round(1 / (1 + math.exp(-min(40, max(-40, z)))), 9)))
    assert got == sorted(want)


def test_training_steps():
    """Two epochs over three examples, step by step in plain numbers."""
    buckets, dim, rate = 8, 2, 0.3
    examples = [(0, [1, 3], [0.5, 0.5]), (1, [2, 3, 5], [0.25, 0.25, 0.5]), (1, [7], [1.0])]
    rng = np.random.default_rng(1)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).tolist()
    out, bias, done = [[0.0] * dim, [0.0] * dim], [0.0, 0.0], 0
    for _ in range(2):
        for k in rng.permutation(3):
            label, ids, share = examples[k]
            step = rate * (1 - done / 6)
            done += 1
            hidden = [sum(s * vectors[i][d] for i, s in zip(ids, share)) for d in range(dim)]
            z = [sum(o * h for o, h in zip(out[c], hidden)) + bias[c] for c in (0, 1)]
            e = [math.exp(x - max(z)) for x in z]
            grad = [x / sum(e) - (c == label) for c, x in enumerate(e)]
            back = [sum(grad[c] * out[c][d] for c in (0, 1)) for d in range(dim)]
            for c in (0, 1):
                out[c] = [o - step * grad[c] * h for o, h in zip(out[c], hidden)]
                bias[c] -= 0.01 * step * grad[c]
            for i, s in zip(ids, share):
                vectors[i] = [v - step * math.sqrt(len(ids)) * s * b for v, b in zip(vectors[i], back)]
    want = [sum(v * (b - a) for v, a, b in zip(row, *out)) for row in vectors] + [bias[1] - bias[0]]
    arrays = [(label, np.array(ids), np.array(share, dtype=np.float32)) for label, ids, share in examples]
    assert np.allclose(classifier.train(arrays, buckets, dim, 2, rate), want, atol=1e-5)


# --- pipeline ---------------------------------------------------------------


def fingerprint(text):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_simhash(rows):
    """The first row, by doc_id, of each component."""
    prints = [fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for g, r in zip(group, rows):
        best[g] = min(best.get(g, r), r, key=lambda x: x[0])
    return sorted(best.values())


def plain_decontamination(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for _, text in items:
        w = words(text)
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    clean = lambda w: not any(tuple(w[i : i + n]) in windows for n in range(1, 11) for i in range(len(w) - n + 1))
    return sorted(r for r in rows if clean(words(r[1])))


def test_rows_of_every_stage(spark, tmp_dir):
    rng = np.random.default_rng(12)
    vocabulary = {"en": " ".join(EN).split(), "de": " ".join(DE).split()}
    rows = []
    for k in range(60):
        lang = "de" if k % 3 == 0 else "en"
        rows.append((k, " ".join(rng.choice(vocabulary[lang], 80)), lang, f"s{k % 4}"))
    rows += [(100 + k, rows[k][1].upper() if k % 2 else rows[k][1], rows[k][2], rows[k][3]) for k in range(10)]
    rows += [(200, "xq zzkw pfgh jjj wvx qqq zxcv bnmm plk", "en", "s1"), (201, "12 34 !!", "en", "s1"), (202, None, None, None), (203, "Übung macht den meister sagt man", None, None)]
    items = [(1, " ".join(rows[7][1].split()[10:24])), (2, rows[8][1][:30]), (None, " ".join(rows[9][1].split()[5:15]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    columns = "doc_id bigint, text string, lang string, source string"
    stages = dict(corpus_pipeline.STAGES)

    found = plain_identify([(t, s, None, None, None) for _, t, _, s in rows], [(t, x) for _, t, x, _ in rows])
    known = sorted(r for r, (_, p, _) in zip(rows, found) if re.search(r"[^\W\d_]", r[1] or "") and p >= language.MIN_CONFIDENCE)
    got = sorted(tuple(r) for r in stages["language_id"](spark, spark.createDataFrame(rows, columns), tmp_dir).collect())
    assert got == known and 50 < len(known) < len(rows)

    kept = plain_simhash(known)
    got = sorted(tuple(r) for r in stages["simhash_near_dedup"](spark, spark.createDataFrame(known, columns), tmp_dir).collect())
    assert got == kept and len(kept) < len(known)

    clean = plain_decontamination(kept, items)
    got = sorted(tuple(r) for r in stages["benchmark_decontamination"](spark, spark.createDataFrame(kept, columns), tmp_dir).collect())
    assert got == clean and len(clean) < len(kept)

    mixed = sorted(tuple(r) for r in stages["mixing"](spark, spark.createDataFrame(clean, columns), tmp_dir).collect())
    size = Counter()
    for r in clean:
        size[r[3]] += len(r[1].split())
    names = sorted(s for s in size if s) + [None] * (None in size)
    weight, target, left, free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, 1.5 * sum(size.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * size[s]}
        for s in full or free:
            target[s] = 2 * size[s] if full else level * weight[s]
        left -= sum(target[s] for s in full)
        free = free - full if full else set()
    taken = Counter()
    for r, copies in Counter(mixed).items():
        assert r in clean and copies <= 2
        taken[r[3]] += copies * len(r[1].split())
    assert all(abs(taken[s] - target[s]) <= 160 for s in names)  # two documents' words

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    want, start = [], 0
    for r in mixed:
        ids = library.encode(r[1], add_special_tokens=False).ids + [2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in stages["token_output"](spark, spark.createDataFrame(mixed, columns), tmp_dir).collect())
    assert got == want
