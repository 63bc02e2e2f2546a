"""Every operator on rows with nulls, empty and long texts, ties, repeats, clashing names, and on no rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from velostat.llm import chat, classifier, decontaminate, language, mixing, quality_rules, simhash, substrings, suffixes, tokens
from velostat.llm.queries import TOKENIZER

from .conftest import HARD_TEXTS

SPACES = r"[^\x20\x09-\x0D]+"


def items(spark):
    rows = [(1, "quick brown fox jumps over the lazy dog again and again"), (2, "same id"), (3, None), (4, ""), (None, "x"), (2, "same id")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (6, 0), (7, 0), (5, 1), (None, 1), (8, None), (1, 1)], "doc_id bigint, label int")


def trusted(spark):
    return spark.createDataFrame([(1,), (5,), (None,), (1,)], "doc_id bigint")


def report(spark, docs):
    return {
        "tokens": lambda: tokens.tokenize(spark, docs, TOKENIZER),
        "suffixes": lambda: suffixes.dedup_suffixes(docs),
        "classifier": lambda: classifier.classify(docs, labels(spark)),
        "rules": lambda: quality_rules.score_quality(docs, trusted(spark)),
        "language": lambda: language.identify(language.document_rows(docs), docs.select("text", "lang")),
        "mixing": lambda: mixing.mixing_report(docs),
        "decontaminate": lambda: decontaminate.find_contamination(docs, items(spark)),
        "simhash": lambda: simhash.fingerprint_report(docs),
        "substrings": lambda: substrings.dedup_substrings(docs),
    }


NAMES = ["tokens", "suffixes", "classifier", "rules", "language", "mixing", "decontaminate", "simhash", "substrings"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_document(spark, hard_docs, name):
    assert report(spark, hard_docs)[name]().count() == len(HARD_TEXTS)


@pytest.mark.parametrize("name", NAMES)
def test_no_documents(spark, no_docs, name):
    assert report(spark, no_docs)[name]().count() == 0


def test_no_reference_tables(spark, hard_docs):
    none = labels(spark).where("false")
    assert {r.score for r in classifier.classify(hard_docs, none).collect()} == {0.5}
    assert {r.score for r in quality_rules.score_quality(hard_docs, none).collect()} == {0.0}
    assert not any(r.contaminated for r in decontaminate.find_contamination(hard_docs, items(spark).where("false")).collect())


def test_tokens_equal_the_library_on_whole_texts(spark, hard_docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    texts = sorted(HARD_TEXTS, key=lambda r: (r[0] is not None, r[0] or 0))
    want = sorted(
        (str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, t in texts
        for ids in [tok.encode(t or "", add_special_tokens=False).ids + [2]]
    )
    rows = tokens.tokenize(spark, hard_docs, TOKENIZER).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_special_token_strings_and_odd_spaces():
    from tokenizers import Tokenizer

    texts = ["a<|endoftext|>b  c", "x y z\x0b\x1cq", "é ́e ΑΣ ΑΣ.", "it's 've I'LL", "\r\n\t", "İstanbul ǅ", "Ab... c., d,. e.\tf.", "A<|ENDOFTEXT|>. B", "x1. 2,3. é.", "a\u0301. b.\u0301 c,"]
    tok = Tokenizer.from_file(TOKENIZER)
    got = [np.frombuffer(x, "<u2").tolist() for x in tokens.Encoder(TOKENIZER).encode(texts)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_random_access_to_sequences(spark, hard_docs, tmp_dir):
    shards = tokens.write_token_files(hard_docs, tmp_dir, TOKENIZER, length=64).collect()
    for s in shards:
        f = tokens.TokenFile(s.path)
        assert len(f) == s.n_sequences == -(-s.n_tokens // 64)
        assert all(len(f.sequence(i)) == 64 for i in range(len(f)))
        assert not f.sequence(0).flags.owndata
        assert sum(sum(f.mask(i).to_pylist()) for i in range(len(f))) == s.n_tokens


def brute_suffixes(rows, length):
    """rows in order; the spans to remove of each text."""
    seen, out = set(), []
    for t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for q in range(len(b) - length + 1):
            if b[q : q + length] in seen:
                gone[q] += 1
                gone[q + length] -= 1
            seen.add(b[q : q + length])
        gone = np.cumsum(gone)[: len(b)] > 0
        out.append((int(gone.sum()), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.fixture(scope="module")
def copies(spark):
    """Random texts over a few words with shared passages, near copies and self-repeats."""
    rng = np.random.default_rng(5)
    vocabulary = ["ab", "c", "déf", "ghij", "k"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 120))) for _ in range(30)]
    texts += [t[: len(t) // 2] + " X " + t[len(t) // 3 :] for t in texts[:10]] + [t + "\n" + t for t in texts[:5]] + texts[3:8]
    return list(enumerate(texts))


def test_suffix_dedup_against_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id bigint, text string")
    for length, gram in ((24, 10), (100, 48)):
        got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffixes.dedup_suffixes(docs, length, gram).collect()}
        assert [got[i] for i, _ in copies] == brute_suffixes([t for _, t in copies], length)


def test_suffix_slices_and_long_texts(spark, copies, monkeypatch):
    """Slices of a few contexts, and texts read in short stretches, change nothing."""
    from velostat.llm import repeats

    monkeypatch.setattr(suffixes, "SLICE", 3)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 64)
    monkeypatch.setattr("velostat.llm.common.BLOCK_BYTES", 64)
    docs = spark.createDataFrame(copies, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffixes.dedup_suffixes(docs, 24, 10).collect()}
    assert [got[i] for i, _ in copies] == brute_suffixes([t for _, t in copies], 24)


def test_multikey_sort():
    rng = np.random.default_rng(3)
    digits = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order, begin = suffixes.multikey_sort(digits)
    rows = [tuple(r) for r in digits[order].tolist()]
    assert rows == sorted(rows)
    assert begin.tolist() == [k for k in range(500) if k == 0 or rows[k] != rows[k - 1]]


def test_substring_dedup_against_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id bigint, text string")
    n = 12
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup_substrings(docs, n, 5).collect()}
    first = {}
    split = {i: re.findall(SPACES, t) for i, t in copies}
    for i, w in split.items():
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k : k + n]), i)
    for i, w in split.items():
        gone = {p for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < i for p in range(k, k + n)}
        assert got[i] == (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))


def test_rules_base_counts(spark, hard_docs):
    docs = hard_docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.score_quality(docs, trusted(spark)).collect()}
    want = set()
    for i, t in {(i, t or "") for i, t in HARD_TEXTS if i is not None}:
        w = re.findall(SPACES, t)
        lines = [x for x in t.split("\n") if re.search(SPACES, x)]
        grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        count = {}
        for g in grams:
            count[g] = count.get(g, 0) + 1
        hit = {p for k, g in enumerate(grams) if count[g] > 1 for p in range(k, k + 8)}
        want.add((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)))
    assert got == want


def test_rules_score_against_brute_force(spark):
    texts = [(1, "a b c a b"), (2, "a b"), (3, "x y z"), (4, "x ! !")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    good = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    buckets = 1 << 16
    got = {r.doc_id: r.score for r in quality_rules.score_quality(docs, good, buckets=buckets).collect()}
    grams = {i: [(x,) for x in t.split()] + list(zip(t.split(), [*t.split()[1:], None])) for i, t in texts}
    raw, target = {}, {}
    for i, g in grams.items():
        for x in g:
            raw[x] = raw.get(x, 0) + 1
            target[x] = target.get(x, 0) + (i in (1, 2))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    for i, g in grams.items():
        want = np.mean([np.log((target[x] + 1) / n_target / ((raw[x] + 1) / n_raw)) for x in g])
        assert got[i] == pytest.approx(want, abs=1e-5)


def test_simhash_components_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centers = rng.integers(0, 1 << 64, 6, dtype=np.uint64)
    fps = set(rng.integers(0, 1 << 64, 60, dtype=np.uint64).tolist())
    for c in centers.tolist():
        walk = c
        for _ in range(60):  # chains of neighbours, some far from their start
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                walk ^= 1 << int(b)
            fps.add(walk)
        fps |= {c ^ (1 << b) for b in range(24, 64)}
    fps = np.array(sorted(fps), dtype=np.uint64)
    parent = {int(x): int(x) for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(fps):
        for y in fps[k + 1 :][np.bitwise_count(fps[k + 1 :] ^ x) <= 4]:
            a, b = find(int(x)), find(int(y))
            parent[max(a, b)] = min(a, b)
    docs = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    for chunk in (1_000, 4):
        from velostat.llm.components import connected_components

        roots = {r.node: r.root for r in connected_components(simhash.fingerprint_links(docs, chunk=chunk)).collect()}
        got, want = [roots.get(int(x), int(x)) for x in fps.view(np.int64)], [find(int(x)) for x in fps]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) < len(fps)
        assert all(g <= x for g, x in zip(got, fps.view(np.int64).tolist()))  # a root is the smallest signed number


def test_near_duplicates_keep_one_of_each_group(spark, hard_docs):
    kept = simhash.drop_near_duplicates(hard_docs)
    assert kept.columns == hard_docs.columns
    roots = {r.root for r in simhash.fingerprint_report(hard_docs).collect()}
    assert kept.count() == len(roots)


def test_decontamination_short_and_long_items(spark, hard_docs):
    got = {(r.doc_id, r.n_words): (r.n_hit, r.n_items) for r in decontaminate.find_contamination(hard_docs, items(spark)).collect()}
    assert got[(1, 15)] == (11, 1)
    assert got[(8, 15)] == (11, 1)
    assert got[(1, 6)] == (2, 1)  # "same id" inside "another text under the same id"
    assert got[(2, 0)] == (0, 0)


def test_mixing_targets_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(k, "w " * int(rng.integers(0, 50)), None if k % 7 == 0 else f"s{k % 5 if k % 3 else 0}") for k in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mixing_report(docs).collect()
    assert out == mixing.mixing_report(docs).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(size.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        for s in over or free:
            target[s] = 2.0 * size[s] if over else level * weight[s]
            left -= target[s]
        free -= over or set(free)
    of = {k: s for k, _, s in rows}
    taken = {}
    for r in out:
        assert r.source_size == size[of[r.doc_id]] and r.target == pytest.approx(target[of[r.doc_id]])
        assert r.taken <= 2 * r.size
        taken[of[r.doc_id]] = taken.get(of[r.doc_id], 0) + r.taken
    assert all(taken[s] == pytest.approx(target[s], rel=0.02) for s in names)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)


def test_language_evidence(spark):
    docs = [(f"the cat and the dog {k} with this", "en") for k in range(20)] + [(f"der hund und die katze {k} mit dem", "de") for k in range(20)]
    labelled = spark.createDataFrame(docs, "text string, lang string")
    rows = [(k, docs[k + 20][0], "de.example.de", "example.de", "de", "de") for k in range(20)]
    rows += [(100, "", "de.example.de", "example.de", "de", "de"), (101, None, None, None, None, None), (102, "the dog and this cat", "x.org", "x.org", "org", "en")]
    text = spark.createDataFrame(rows, "id bigint, text string, host string, domain string, suffix string, declared string")
    got = {r.id: r for r in language.identify(text.selectExpr("*", "id as key"), labelled).collect()}
    assert got[100].lang == "de" and got[100].text_lang is None and got[100].confidence > 0.9
    assert got[102].lang == "en"
    assert got[0].lang == "de"
    assert got[101].lang == "de"  # no evidence: the most frequent language


def test_page_evidence(spark):
    html = '<html lang="FR-fr"><script>var x="<p>";</script><p>Bonjour <b>tout</b></p><!-- no --></html>'
    rows = [(1, "https://user@A.B.example.co:80/x", html), (2, None, None), (3, "not a url", "<p>")]
    got = {r.id: r for r in language.page_rows(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert (got[1].host, got[1].domain, got[1].suffix, got[1].declared) == ("a.b.example.co", "example.co", "co", "fr")
    assert got[1].text.split() == ["Bonjour", "tout"]
    assert got[2].host is None and got[3].host is None and got[2].text == ""


def test_classifier_learns(spark):
    rng = np.random.default_rng(6)
    good, bad = ["river", "stone", "light", "garden"], ["!!$$", "BUY", "***now", "%%%"]
    rows = [(k, " ".join(rng.choice(bad if k % 4 == 0 else good, 30))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(400)], "doc_id bigint, label int")
    out = classifier.classify(docs, truth).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(400) if zlib.crc32(str(k).encode()) % 3 == 1}
    assert np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in held]) > 0.95
    assert [(r.doc_id, r.score) for r in classifier.classify(docs, truth).collect()] == [(r.doc_id, r.score) for r in out]


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", r"<\s> <\\/s> [\INST] [/INST", "<<SYS>> x <</SYS>> <<s>", "", None, "\\", "a\nb", "<s", "[[INST]]"]
    rows = [(1, k, role, t) for k, t in enumerate(hard) for role in ("user", "assistant")]
    rows += [(2, 0, "odd\nrole\\n<s>", "x"), (2, None, None, "y"), (2, 0, "user", "tie"), (2, 0, "user", "tie"), (None, 1, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as body", "2 as segments")
    out = chat.format_conversations(df)
    assert all(r.identical for r in out.collect())
    got = {r.conv_id: r for r in chat.conversation_digests(out).collect()}
    turns = [(t, r or "", x or "") for c, t, r, x in rows if c == 1]
    said = "".join(x or "" for c, _, r, x in sorted(rows[:18], key=lambda y: y[1]) if r == "assistant")
    told = "".join(f"{r}\n{x}\n" for _, r, x in sorted(turns))
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert got[2].n_turns == 4 and got[None].n_turns == 1
    assert chat.format_conversations(df.where("false")).count() == 0
    for r in out.collect():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_pipeline_stages_on_hard_rows(spark, hard_docs, no_docs, tmp_dir):
    items(spark).write.parquet(f"{tmp_dir}/benchmark.parquet")
    for docs in (hard_docs, no_docs):
        for name, step in corpus_pipeline.STAGES[:-1]:
            after = step(spark, docs, tmp_dir)
            assert after.columns == docs.columns, name
            after.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tmp_dir).count() == docs.count()


def test_pipeline_decisions(spark, hard_docs, tmp_dir):
    items(spark).write.parquet(f"{tmp_dir}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = [r.text for r in stages["language_id"](spark, hard_docs, tmp_dir).collect()]
    assert sorted(known) == sorted(t for _, t in HARD_TEXTS if t and t.strip())
    clean = [r.text for r in stages["benchmark_decontamination"](spark, hard_docs, tmp_dir).collect()]
    assert not any(t and ("same id" in t or "quick brown" in t.lower()) for t in clean)
    assert len(clean) == len(HARD_TEXTS) - 4


def test_classifier_sees_repetition(spark):
    """Good and bad texts draw from the same words; the bad ones say one passage again and again."""
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"word{k}" for k in range(300)])
    rows = []
    for k in range(400):
        once = rng.choice(vocabulary, 15 if k % 4 == 0 else 60)
        rows.append((k, " ".join(np.tile(once, 4) if k % 4 == 0 else once)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    truth = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(400)], "doc_id bigint, label int")
    out = [r for r in classifier.classify(docs, truth).collect() if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in out]) > 0.95


def test_classifier_features_against_a_plain_loop():
    """The repetition feature: starts of a run of three words that the same text had before."""
    import pyarrow as pa

    from velostat.llm.common import text_blocks

    texts = ["a b c a b c a", "", "a b", "x y z", "a b c q a b c", None, "k k k k k"]
    block = next(text_blocks(pa.array(texts)))
    owners = list(classifier.features(block, 1 << 17))[-1][1]
    want = []
    for t in texts:
        w = (t or "").split()
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        want.append(sum(g in grams[:i] for i, g in enumerate(grams)))
    assert np.bincount(owners, minlength=len(texts)).tolist() == want
