"""Every operator against a plain version, over a table of odd texts and over whole tables."""

import functools
import random
import re
from collections import Counter

from . import brute_llm as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import minhash, mixing, packing, pii, quality_model, quality_rules, simhash, substring_dedup, token_counts, token_store
from folioscope.llm.components import components
from folioscope.llm.encoding import Encoder, public_path, split_safely
from folioscope.llm.oracles import ORACLES
from folioscope.llm.queries import QUERIES

from .conftest import SCHEMA, SF, odd_texts, rows_of


def bag(rows):
    return Counter(map(tuple, rows))


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module", params=["odd", "documents"])
def table(request):
    return request.getfixturevalue(request.param)


# Tokenizers ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_agrees_with_the_library(name):
    from tokenizers import Tokenizer

    rnd = random.Random(3)
    signs = [" ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", "　", "᠎", "́", "a", "B", "İ", "ß", "Σ", "!", "1", "中", "😀", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "\x00", "é", " a", " b"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(40))) for _ in range(3000)] + [t or "" for _, t, _ in odd_texts()]
    want = [e.ids for e in Tokenizer.from_file(public_path(name)).encode_batch(texts, add_special_tokens=False)]
    coder = Encoder(public_path(name), most=500)
    for _ in range(2):
        ids, n = coder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
        assert coder.count(texts).tolist() == list(map(len, want))


def test_long_texts_are_cut_where_white_space_begins():
    text = " ".join(["word", "é", "x  y"] * 400)
    parts = list(split_safely(text, 100))
    assert "".join(parts) == text and len(parts) > 10 and all(p[0] == " " for p in parts[1:])
    assert list(split_safely("x" * 500, 100)) == ["x" * 500]


@functools.cache
def _tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path(name))


def _ids(name, text):
    return _tokenizer(name).encode(text or "", add_special_tokens=False).ids


def test_token_counts(table):
    counts = [(k, len((t or "").encode()), len(_ids("word_bpe_49k.json", t))) for k, t in pairs(table)]
    edge = sorted(n for *_, n in counts)[-2]  # one text has more, at least one exactly as many
    for limit in (100, 2048, edge):
        assert bag(token_counts.count_tokens(table, limit=limit).collect()) == bag((*c, c[-1] > limit) for c in counts)


# Personal data ------------------------------------------------------------------------------------

def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(5)
    signs = list("0123456789") * 2 + list(".+- ()@ab%_") + [" ", "1.2.3.4", "4111111111111111", "a@b.c", "+1 555 ", "é", "😀"]
    for _ in range(6000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(60)))
        spans = pii.find_spans(text)
        counts, _ = brute.base_pii(text)
        assert [len(spans[k]) for k in pii.BASE_KINDS] == counts, text
        assert pii._written(spans, pii.BASE_KINDS) == ",".join(f"{k}:{m[0]}:{m[1]}" for k in pii.BASE_KINDS for m in spans[k])


def test_pii_rows(table):
    got = bag((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.find_pii(table).collect())
    assert got == bag((k, *c, h) for k, t in pairs(table) for c, h in [brute.base_pii(t)])


def test_further_kinds_and_redaction():
    text = "IBAN DE89 3704 0044 0532 0130 00, account: 12345678; password=e3b3ed3cc8 see https://me:pw@host.org/x and https://host.org"
    spans = pii.find_spans(text)
    assert [text[s:e] for k in pii.MORE_KINDS for s, e in spans[k]] == ["https://me:pw@host.org/x", "DE89 3704 0044 0532 0130 00", "12345678", "e3b3ed3cc8"]
    assert "[IBAN]" in pii.redact(text, spans) and "3704" not in pii.redact(text, spans)
    assert not any(pii.find_spans("the token of iban account password secret 12:30 at 5").values())


# Quality ------------------------------------------------------------------------------------------

def test_quality_base(table):
    got = quality_rules.judge(table, ["doc_id"]).collect()
    assert bag(r[:7] for r in got) == bag((k, *brute.base_quality(t)) for k, t in pairs(table))
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_robust_outliers_are_rejected(spark):
    rnd = random.Random(1)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(n))
    clean = [(i, say(rnd.randrange(30, 200))) for i in range(200)]
    junk = [(1000 + i, " ".join(w + "$$$" for w in say(60).split())) for i in range(40)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows_of(clean + junk), SCHEMA), ["doc_id"]).collect()}
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in junk)


@pytest.mark.parametrize("share", [0.25, 0.4])
@pytest.mark.parametrize("kind", ["symbols", "tables", "capitals"])
def test_much_junk_is_rejected_and_repeated_lines_are_kept(spark, share, kind):
    """Up to nearly half of a group may be junk; one repeated line makes none."""
    rnd = random.Random(2)
    say = lambda n: [" ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(8, 16))) for _ in range(n)]
    spoil = {"symbols": lambda w: w + "$$$", "tables": lambda w: w + " |", "capitals": str.upper}[kind]
    lines = [say(rnd.randrange(15, 30)) for _ in range(300)]
    texts = ["\n".join(x + x[:1] if i % 10 == 0 else x) for i, x in enumerate(lines)]
    junk = int(len(texts) * share)
    rows = [(i, " ".join(map(spoil, t.split())) if i < junk else t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows_of(rows), SCHEMA), ["doc_id"]).collect()}
    assert not any(got[i] for i in range(junk)) and all(got[i] for i in range(junk, len(rows)))


def test_quality_model(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_model.fit(documents, labels)
    again = quality_model.fit(documents, labels)
    assert (model.weight == again.weight).all()
    got = {r["doc_id"]: r for r in quality_model.score(documents, model).collect()}
    assert len(got) == documents.count()
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())


def test_quality_model_separates_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_model.score(docs.join(labels.select("doc_id"), "doc_id"), quality_model.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.3 for g in good]) > 0.97


def test_quality_model_takes_odd_texts(spark, odd, none):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 16)] + [(None, 1)], "doc_id long, quality int")
    model = quality_model.fit(odd, labels)
    rows = quality_model.score(odd, model).collect()
    assert len(rows) == odd.count() and len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality_model.score(none, quality_model.fit(none, labels)).collect() == []



def _letters(rnd, n):
    return ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9))) for _ in range(n)]


def test_tables_of_words_are_rejected(spark):
    rnd = random.Random(2)
    clean = [(i, " ".join(_letters(rnd, rnd.randrange(30, 200)))) for i in range(300)]
    junk = [(1000 + i, "\n".join(" | ".join(_letters(rnd, 3)) for _ in range(30))) for i in range(30)]
    got = {r["doc_id"]: (r["kept"], r["distance"]) for r in quality_rules.judge(spark.createDataFrame(rows_of(clean + junk), SCHEMA), ["doc_id"]).collect()}
    assert all(got[i][0] for i, _ in clean) and not any(got[i][0] for i, _ in junk)


@pytest.mark.parametrize("share", [25, 33, 40])
def test_groups_with_much_junk(spark, share):
    rnd = random.Random(share)
    clean = [(i, " ".join(_letters(rnd, rnd.randrange(30, 200)))) for i in range(300 - 3 * share)]
    junk = [(1000 + i, " ".join(w + "$$$" for w in _letters(rnd, 60))) for i in range(3 * share)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows_of(clean + junk), SCHEMA), ["doc_id"]).collect()}
    assert all(got[i] for i, _ in clean) and not any(got[i] for i, _ in junk)


# Near duplicates ----------------------------------------------------------------------------------

def test_simhash(table):
    rows = pairs(table)
    prints = [(k, brute.fingerprint(t)) for k, t in rows]
    want = bag((k, f, c) for (k, f), c in zip(prints, brute.components(prints)))
    assert bag((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(table).collect()) == want


def test_ball_links_connect_all_close_fingerprints(spark):
    rnd = random.Random(2)
    fps = {rnd.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(12):
            f ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64)) if rnd.random() < 0.7 else 7 << rnd.randrange(60)
            fps.add(f)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    links = simhash.ball_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 2 for r in links.collect())
    found = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute.components([(f, f % (1 << 64)) for f in fps])
    assert [found.get(f, f) for f in fps] == want


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(4).shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1002)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(n), 0), **dict.fromkeys((1000, 1001, 1002), 1000)}


def test_keep_one(table):
    rows = simhash.keep_one(table)
    assert rows.columns == table.columns
    found = {(r["doc_id"]) for r in simhash.near_duplicates(table).where("doc_id <=> component_id").collect()}
    kept = [r["doc_id"] for r in rows.collect()]
    assert len(kept) == len(set(kept)) and set(kept) - {None} == found - {None}


def test_minhash_edits(table):
    import hashlib

    rows = sorted(pairs(table), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = minhash.fingerprint_edits(table).collect()
    assert len(got) == len(rows)
    ids = [k for k, _ in rows]
    if len(set(ids)) == len(ids):
        want = {}
        for (k, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
            t, n, c = t or "", n or "", len(t or "") // 3
            want[k] = (len(t), hashlib.sha256((t[:len(t) - c] + n[:c]).encode()).hexdigest())
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
        assert np.mean([r["near_edited"] for r in got]) > 0.3 > 0.1 > np.mean([r["near_next"] for r in got])
    by_text = {}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == 256 for r in got)
    texts = dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"] or ids.count(r["doc_id"]) > 1


def _shingles(text):
    w = brute.words(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_minhash_estimates_jaccard():
    rnd = random.Random(9)
    for share in (0.2, 0.5, 0.8):
        a = [f"w{rnd.randrange(10**6)}" for _ in range(800)]
        b = a[:int(800 * share)] + [f"v{i}" for i in range(300)]
        s, t = _shingles(" ".join(a)), _shingles(" ".join(b))
        x, y = minhash.compact(minhash.signatures([" ".join(a).encode(), " ".join(b).encode()]))
        assert abs(minhash.likeness(x[None], y[None])[0] - len(s & t) / len(s | t)) < 0.16


def test_minhash_near_duplicates(spark):
    rnd = random.Random(11)
    texts = []
    for g in range(12):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
        for _ in range(5):
            own = list(base)
            own[rnd.randrange(200)] = f"n{rnd.randrange(10**6)}"
            texts.append(" ".join(own))
        texts.append(" ".join(base[:90] + [f"x{i}{g}" for i in range(110)]))
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[0]), (101, None), (102, "")]
    root = {i: i for i, _ in rows}
    sets = {i: _shingles(t) for i, t in rows}
    for i, _ in rows:
        for j, _ in rows:
            if j < i and (sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                a, b = root[i], root[j]
                root = {k: min(a, b) if v in (a, b) else v for k, v in root.items()}
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert got == root


def _classes(rows):
    """Smallest key of every row's class, from all pairs."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, _shingles(t)) for i, t in rows]
    for n, (i, s) in enumerate(sets):
        for j, t in sets[:n]:
            if find(i) != find(j) and len(s & t) >= 0.8 * len(s | t):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def test_near_duplicates_of_odd_rows(odd):
    rows = pairs(odd)
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if len(a & b) >= 0.8 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    least = {r: min((k for (k, _), x in zip(rows, root) if x == r and k is not None), default=None) for r in root}
    got = minhash.near_duplicates(odd)
    assert bag(got.select("doc_id", "class_id").collect()) == bag((k, least[r]) for (k, _), r in zip(rows, root))


def test_minhash_with_many_variants(spark):
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    texts = []
    for _ in range(400):
        own = list(base)
        for i in rnd.sample(range(300), rnd.randrange(2, 11)):
            own[i] = f"n{rnd.randrange(10**6)}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert got == _classes(rows)


def test_signatures_are_least_values_of_shingles(table):
    """Against plain integers: one hash per distinct shingle, the least of each permutation, likeness near the true Jaccard."""
    texts = [t or "" for _, t in pairs(table)][:60]
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, at = minhash.shingles(raw)
    own = [set(hashes[at[i]:at[i + 1]].tolist()) for i in range(len(raw))]
    sets = [_shingles(t) for t in texts]
    assert [len(o) for o in own] == [len(s) for s in sets]
    assert len(set().union(*own)) == len(set().union(*sets))
    sig = minhash.signatures(raw)
    for i, o in enumerate(own):
        want = [min(((h * int(f) + int(c)) % 2**64 for h in o), default=2**64 - 1) for f, c in zip(minhash.FACTORS, minhash.OFFSETS)]
        assert sig[i].tolist() == want
    small = minhash.compact(sig)
    for i in range(0, len(raw) - 1):
        union = sets[i] | sets[i + 1]
        true = len(sets[i] & sets[i + 1]) / len(union) if union else 1.0
        same = sum(a == b for a, b in zip(small[i].tolist(), small[i + 1].tolist())) / 128
        assert minhash.likeness(small[i:i + 1], small[i + 1:i + 2])[0] == pytest.approx(max(0.0, (same - 1 / 256) / (255 / 256))) and abs(same - true) < 0.2


def test_training_and_scoring_equal_plain_loops():
    """The same steps on floats of Python, text by text; scores as averages of features' weights."""
    import math

    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["good", "fine", "text", "word"] if i % 2 else ["spam", "$$$", "buy", "word"]) for _ in range(rnd.randrange(0, 12))) for i in range(24)]
    def plain(t):
        return Counter(x for f, _ in quality_model.features([t.encode()]) for x in f.tolist())

    counted = [(np.array(sorted(c), np.int64), np.array([c[x] for x in sorted(c)], np.int64), i % 2) for i, c in enumerate(map(plain, texts))]
    model = quality_model.train(counted, epochs=3, seed=1)
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.1, (quality_model.KINDS << quality_model.BUCKET_BITS, quality_model.DIM)).astype(np.float32)
    output, bias = rng.normal(0, 0.1, (quality_model.DIM, 2)).tolist(), [0.0, 0.0]
    held = {int(x): [float(v) for v in vectors[x]] for ids, _, _ in counted for x in ids}
    for epoch in range(3):
        rate, order = quality_model.RATE * (1 - epoch / 3), rng.permutation(len(counted)).tolist()
        for lo in range(0, len(order), quality_model.BATCH):
            part = [counted[i] for i in order[lo:lo + quality_model.BATCH]]
            steps = []
            for ids, n, y in part:
                share = [c / max(int(n.sum()), 1) for c in n.tolist()]
                mean = [sum(w * held[x][d] for w, x in zip(share, ids.tolist())) for d in range(quality_model.DIM)]
                z = [sum(m * o[k] for m, o in zip(mean, output)) + bias[k] for k in (0, 1)]
                e = [math.exp(v - max(z)) for v in z]
                g = [v / sum(e) - (k == y) for k, v in enumerate(e)]
                steps.append((ids.tolist(), share, mean, g, [sum(o[k] * g[k] for k in (0, 1)) for o in output]))
            for d in range(quality_model.DIM):
                for k in (0, 1):
                    output[d][k] -= rate * sum(s[2][d] * s[3][k] for s in steps) / len(part)
            for k in (0, 1):
                bias[k] -= rate * sum(s[3][k] for s in steps) / len(part)
            for ids, share, _, _, back in steps:
                for x, w in zip(ids, share):
                    held[x] = [v - rate * 20 * w * b for v, b in zip(held[x], back)]
    want = []
    for t in texts:
        c = plain(t)
        total = sum(n * sum(v * (o[1] - o[0]) for v, o in zip(held[x], output)) for x, n in c.items()) / max(sum(c.values()), 1)
        want.append(1 / (1 + math.exp(-(total + bias[1] - bias[0]))))
    assert model.score([t.encode() for t in texts]) == pytest.approx(want, abs=1e-4)


# Mixing and packing -------------------------------------------------------------------------------

def test_targets_and_mix(table):
    got = mixing.mix(table).collect()
    rows = [(r["doc_id"], r["source"], len(brute.words(r["text"]))) for r in table.collect()]
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    want = brute.targets(dict(sizes))
    assert bag((r["doc_id"], r["source"], r["size"]) for r in got) == bag(rows)
    assert all(r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) <= 1e-6 * max(1, want[r["source"]]) for r in got)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    longest = {s: max(n for _, x, n in rows if x == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= max(1, longest[s]) for s in sizes)
    assert bag(mixing.mix(table).collect()) == bag(got)


def test_fill_finds_the_best_sum():
    rnd = random.Random(6)
    for _ in range(200):
        s = np.unique([rnd.randint(1, 50) for _ in range(rnd.randint(1, 8))])
        c = np.array([rnd.randint(1, 6) for _ in s])
        budget, reach = rnd.randint(0, int((s * c).sum())), {0}
        for a, b in zip(s.tolist(), c.tolist()):
            reach = {x + a * j for x in reach for j in range(b + 1)}
        assert (mixing.fill(s, c, budget) * s).sum() == max(x for x in reach if x <= budget)
        rough = mixing.fill(s, c, budget, exact=10)
        assert (rough <= c).all() and (rough * s).sum() <= budget


def test_mixed_rows(odd, documents):
    for table in (odd, documents):
        rows = mixing.mixed_rows(table)
        assert rows.columns == table.columns
        want = Counter()
        for r in mixing.mix(table).collect():
            want[r["doc_id"], r["size"]] += r["copies"]
        assert Counter((r["doc_id"], len(brute.words(r["text"]))) for r in rows.collect()) == +want


def test_mixed_rows_that_share_keys(spark):
    """Half of the rows have no key or the same one, of few sizes, many of them equal: all are taken as often as decided."""
    rnd = random.Random(4)
    rows = [(rnd.choice([None, None, 7, i]), " ".join(["w"] * rnd.randrange(1, 4) + rnd.choice([[], ["x"]])), rnd.choice(["s", "t", None])) for i in range(400)]
    table = spark.createDataFrame(rows_of(rows), SCHEMA)
    got = [tuple(r) for r in mixing.mixed_rows(table).collect()]
    want = Counter()
    for r in mixing.mix(table).collect():
        want[r["doc_id"], r["size"], r["source"]] += r["copies"]
    assert Counter((r[0], len(brute.words(r[1])), r[3]) for r in got) == +want
    given, taken = bag(map(tuple, table.collect())), bag(got)
    assert set(taken) <= set(given) and all(n <= 3 * given[r] for r, n in taken.items()) and bag(map(tuple, mixing.mixed_rows(table).collect())) == taken


def test_best_fit_plan_equals_best_fit_by_piece():
    import bisect

    rnd = random.Random(1)
    for _ in range(150):
        cap = rnd.choice([10, 37, 64])
        counts = {rnd.randint(1, cap): rnd.randint(1, 40) for _ in range(rnd.randint(1, 20))}
        plan, rooms, n = packing.plan_best_fit(counts, cap), [], 0
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                i = bisect.bisect_left(rooms, length)
                room = rooms.pop(i) if i < len(rooms) else cap
                n += i >= len(rooms) and room == cap
                if room > length:
                    bisect.insort(rooms, room - length)
        assert plan.sequences <= n or plan.sequences == n


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(table, capacity):
    rows = packing.pack(table, capacity=capacity).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= 1.1 * total / capacity + 2
    want = []
    for k, t in pairs(table):
        ids = _ids("word_bpe_49k.json", t) + [0]
        want += [(k, p, lo, len(ids[lo:lo + capacity]), brute.crc(ids[lo:lo + capacity])) for p, lo in enumerate(range(0, len(ids), capacity))]
    assert bag(r[:5] for r in rows) == bag(want)


def test_sequences_hold_their_ids(odd):
    found = packing.sequences(odd, capacity=512).collect()
    ids = sorted(x for r in found for x in np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == sorted(x for _, t in pairs(odd) for x in _ids("word_bpe_49k.json", t) + [0])
    assert all(len(r["ids"]) <= 4 * 512 for r in found)


# Token store --------------------------------------------------------------------------------------

def test_codes_give_any_id():
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0, np.uint32), rng.integers(0, 200, 700), rng.integers(0, 50257, 3000), rng.integers(0, 1 << 32, 2000, dtype=np.uint32), np.array([2**32 - 1])):
        codes = token_store.Codes(token_store.encode_ids(np.asarray(ids, np.uint32)))
        assert codes.all().tolist() == list(ids) and [codes[i] for i in range(0, len(ids), 7)] == list(ids[::7])


def test_token_store(spark, table):
    from folioscope.session import shared_dir

    folder = f"{shared_dir(spark)}/store-{random.getrandbits(60)}"
    got = token_store.stored_documents(table, folder=folder).collect()
    assert len(got) == table.count()
    order = sorted(got, key=lambda r: r["start"])
    at = 0
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in order]
    assert ids == sorted(ids, key=lambda k: (k is None, k or 0))
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag((k, len(i), brute.crc(i)) for k, t in pairs(table) for i in [_ids("byte_bpe_50k.json", t) + [2]])
    places = spark.createDataFrame([(r["start"] + r["n_tokens"] - 1,) for r in order], "place long")
    assert {r["id"] for r in token_store.read_ids(spark, folder, places).collect()} == {2}


def test_single_ids_open_their_part_alone(spark, documents, monkeypatch):
    from folioscope.session import shared_dir

    monkeypatch.setattr(token_store, "SEGMENT_IDS", 2000)
    folder = f"{shared_dir(spark)}/store-{random.getrandbits(60)}"
    got = sorted(token_store.stored_documents(documents.where("doc_id < 60"), folder=folder).collect(), key=lambda r: r["start"])
    texts = dict(pairs(documents))
    every = [x for r in got for x in _ids("byte_bpe_50k.json", texts[r["doc_id"]]) + [2]]
    rnd = random.Random(1)
    asked = [rnd.randrange(len(every)) for _ in range(50)] * 2 + [0, len(every) - 1, len(every), -1, 10**12, None]
    found = token_store.read_ids(spark, folder, spark.createDataFrame([(p,) for p in asked], "place long"))
    assert bag(found.collect()) == bag((p, every[p] if p is not None and 0 <= p < len(every) else None) for p in asked)
    one = token_store.read_ids(spark, folder, spark.createDataFrame([(5,)], "place long"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#[0-9]+[^\]]*= 0", plan) and re.search(r"PushedFilters: \[[^\]]*EqualTo\(seq,0\)", plan)
    empty = f"{shared_dir(spark)}/store-{random.getrandbits(60)}"
    assert token_store.stored_documents(documents.limit(0), folder=empty).count() == 0
    assert [r["id"] for r in token_store.read_ids(spark, empty, spark.createDataFrame([(5,)], "place long")).collect()] == [None]


# Substrings ---------------------------------------------------------------------------------------

def test_drop_repeated(table):
    got = substring_dedup.drop_repeated(table).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert bag(got.collect()) == bag(brute.drop_repeated(pairs(table)))


def test_drop_repeated_with_shared_passages(spark):
    rnd = random.Random(8)
    say = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    shared = [say(rnd.randrange(50, 130)) for _ in range(6)]
    rows = []
    for i in range(60):
        w = say(rnd.randrange(0, 60))
        for _ in range(rnd.randrange(3)):
            p = rnd.choice(shared)
            lo = rnd.randrange(0, len(p) - 49)
            w += p[lo:] + say(rnd.randrange(5))
        rows.append((i, " ".join(w)))
    rows += [(60, "same " * 200), (61, "same " * 120)]
    got = substring_dedup.drop_repeated(spark.createDataFrame(rows_of(rows), SCHEMA)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    assert bag(got.collect()) == bag(brute.drop_repeated(rows))


# All ----------------------------------------------------------------------------------------------

def test_empty_tables(spark, none):
    for found in (token_counts.count_tokens(none), pii.find_pii(none), quality_rules.judge(none, ["doc_id"]), quality_rules.keep_good(none), simhash.near_duplicates(none),
                  simhash.keep_one(none), minhash.fingerprint_edits(none), minhash.near_duplicates(none), mixing.mix(none), mixing.mixed_rows(none), packing.pack(none),
                  substring_dedup.drop_repeated(none), token_store.stored_documents(none), pii.redact_pii(none)):
        assert found.collect() == []


def test_queries_cover_their_table(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in list(QUERIES.items())[:10]:
        rows = query(spark, SF).collect()
        assert len({r["doc_id"] for r in rows}) == n, name


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql_agrees(spark, name):
    import duckdb

    duck = duckdb.connect()
    for sf in (SF, "/root/testdata/sf0.01"):
        for t in ("documents", "benchmark", "conversations", "embeddings"):
            duck.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
        frame = duck.execute(ORACLES[name])
        columns = [c[0] for c in frame.description]
        assert bag(QUERIES[name](spark, sf).select(*columns).collect()) == bag(frame.fetchall())


# The pipeline -------------------------------------------------------------------------------------

def test_pipeline_equals_its_plain_version(spark):
    import corpus_pipeline

    docs, sf = spark.read.parquet(f"{SF}/documents.parquet"), SF
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "pii", "mixing", "packing"]
    # Quality: the verdicts of the operator, which are held against SQL; all columns unchanged.
    kept = stages["quality_rules"](spark, docs, sf)
    verdict = {r["doc_id"] for r in quality_rules.judge(docs, ["doc_id"]).where("kept").collect()}
    rows = [tuple(r) for r in kept.collect()]
    assert bag(rows) == bag(r for r in map(tuple, docs.collect()) if r[0] in verdict)
    # Near duplicates: the smallest key of every component.
    prints = [(r[0], brute.fingerprint(r[1])) for r in rows]
    least = {c for c in brute.components(prints)}
    single = stages["near_dedup"](spark, kept, sf)
    rows = [r for r in rows if r[0] in least]
    assert bag(map(tuple, single.collect())) == bag(rows)
    # Personal data.
    clean = stages["pii"](spark, single, sf)
    rows = [(r[0], t, r[2], r[3], len(t)) for r in rows for t in [pii.redact(r[1], pii.find_spans(r[1]))]]
    assert bag(map(tuple, clean.collect())) == bag(rows)
    assert not any(sum(brute.base_pii(r[1])[0]) for r in rows)
    # Mixing: sources come near their targets and no document is taken more than three times.
    mixed = [tuple(r) for r in stages["mixing"](spark, clean, sf).collect()]
    sizes, taken, size = Counter(), Counter(), {r[0]: len(brute.words(r[1])) for r in rows}
    for r in rows:
        sizes[r[3]] += size[r[0]]
    for r in mixed:
        taken[r[3]] += size[r[0]]
    want = brute.targets(dict(sizes))
    longest = {s: max(size[r[0]] for r in rows if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in sizes) and max(bag(mixed).values()) <= 3 and set(mixed) <= set(rows)
    # Packing: every piece of every taken document once.
    packed = corpus_pipeline.run(spark, sf).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    pieces = [(r[0], p, lo, len(ids[lo:lo + 2048]), brute.crc(ids[lo:lo + 2048])) for r in mixed for ids in [_ids("word_bpe_49k.json", r[1]) + [0]] for p, lo in enumerate(range(0, len(ids), 2048))]
    assert bag(packed) == bag(pieces)


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark, odd, none):
    import corpus_pipeline

    stages, given = dict(corpus_pipeline.STAGES), bag(map(tuple, odd.collect()))
    for name in ("quality_rules", "near_dedup", "mixing"):
        out = stages[name](spark, odd, SF)
        got = bag(map(tuple, out.collect()))
        assert out.columns == odd.columns and set(got) <= set(given)
        if name == "near_dedup":
            assert sum(got.values()) == len(set(brute.components([(k, brute.fingerprint(t)) for k, t in pairs(odd)])))
        if name == "quality_rules":
            assert all(got[r] == given[r] for r in got) and not any(brute.base_quality(r[1])[-1] for r in got)
        if name == "mixing":
            assert all(n <= 3 * given[r] for r, n in got.items())
    clean = stages["pii"](spark, odd, SF)
    assert clean.columns == odd.columns and bag((r["doc_id"], r["text"], r["n_chars"], r["key"]) for r in clean.collect()) == bag(
        (r["doc_id"], t, None if t is None else len(t), r["key"]) for r in odd.collect() for t in [r["text"] and pii.redact(r["text"], pii.find_spans(r["text"]))])
    packed = stages["packing"](spark, odd, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in odd.collect())
    assert all(stage(spark, none, SF).collect() == [] for stage in stages.values())


def test_pipeline_removes_near_copies(spark):
    """Copies, copies in capitals and texts of two changed words in 2,000: those within two bits leave one document."""
    import corpus_pipeline

    rnd = random.Random(13)
    texts = []
    for _ in range(12):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(2000)]
        texts += [" ".join(base), " ".join(base).upper(), "  ".join(base), " ".join([*base[:700], "n1", *base[701:1500], "n2", *base[1501:]])]
    rows = list(enumerate(texts))
    single = dict(corpus_pipeline.STAGES)["near_dedup"](spark, spark.createDataFrame(rows_of(rows), SCHEMA), SF)
    want = sorted(set(brute.components([(i, brute.fingerprint(t)) for i, t in rows])))
    assert sorted(r["doc_id"] for r in single.collect()) == want and 12 <= len(want) < 24
