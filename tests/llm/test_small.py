"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and against brute force."""

import base64
import bisect
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import byte_bpe, chat, common, dart_minhash, exact_dedup, language_id, licenses, near_dup, nearest, packing, pieces, pii, pii_rules, queries, semi_crf, shards
from tests.oracle import same

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))


def docs(spark, rows, extra=()):
    """rows: (doc_id, text); extra: names of further columns."""
    df = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit("clash") for c in extra}) if extra else df


HARD = [(1, "a  b"), (2, None), (3, ""), (4, "a\tb"), (5, LONG), (1, "a  b"), (1, "other"), (None, "a b"), (None, None), (6, LONG), (7, "  \x0b"), (8, "   ")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    same(queries.QUERIES[name](spark, SF), queries.ORACLE_SQL[name], SF)


# --- exact dedup ---


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return groups


def test_exact(spark):
    got = exact_dedup.dedup_groups(docs(spark, HARD, ["row", "run", "kept", "norm", "sha"])).collect()
    groups = brute_exact(HARD)
    assert len(got) == len(HARD)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for sha, ids in by_sha.items():
        mine = [r for r in got if r["text_sha256"] == sha]
        known = [i for i in ids if i is not None]
        assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in mine)
        assert {r["keep_id"] for r in mine} == {min(known) if known else None} and {r["group_size"] for r in mine} == {len(ids)} and sum(r["kept"] for r in mine) == 1
    kept = exact_dedup.dedup(docs(spark, HARD, ["row", "kept", "__id", "mark", "n"]))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "kept", "__id", "mark", "n"]
    assert sorted(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()) == sorted(groups)
    assert exact_dedup.dedup_groups(docs(spark, [])).count() == 0 and exact_dedup.dedup(docs(spark, [])).count() == 0


def test_exact_levels(spark):
    """Every level: runs are sorted, a digest is in a run once, with the smallest identifier and the count of the runs merged so far."""
    rows = docs(spark, [(i, "same" if i % 3 else f"t{i % 200}") for i in range(600)])
    digests = exact_dedup.in_runs(exact_dedup.digest_rows(rows).checkpoint(), 3)
    plain = [(r["sha"], r["run"], r["doc_id"]) for r in digests.collect()]
    low, levels = exact_dedup.merge_runs(digests, 3, 2)
    assert low.groupBy(*exact_dedup.KEY, "run").count().filter("count > 1").isEmpty()
    for k, level in enumerate(levels):
        held = level.collect()
        want = defaultdict(list)
        for sha, run, i in plain:
            want[run >> 2 * k, bytes(sha)].append(i)
        got = {}
        for r in held:
            shas = [bytes(e["sha"]) for e in r["run_part"]]
            assert shas == sorted(set(shas)) and all(int.from_bytes(x[:4]) * 2 * 4**k >> 32 == r["range"] for x in shas)
            got |= {(r["run"], bytes(e["sha"])): (e["first"]["doc_id"], e["n"]) for e in r["run_part"]}
        assert got == {key: (min(ids), len(ids)) for key, ids in want.items()}
    assert {r["run"] for r in levels[-1].collect()} == {0} and len({r["run"] for r in levels[0].collect()}) == 64
    assert exact_dedup.rounds_for(10) == 2 and exact_dedup.rounds_for(10**9) == 4 and exact_dedup.rounds_for(5 * 10**10) == 7


# --- near-duplicates ---


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute_classes(rows, least=0.8):
    """A shingle of five words that occurs n times weighs the length of n in bits."""
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append((i, Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter([("text", " ".join((t or "").split()))])))
    sets = [(i, Counter({k: n.bit_length() for k, n in x.items()})) for i, x in sets]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if (x & y).total() >= least * (x | y).total():
            parent[max(root(a), root(b))] = min(root(a), root(b))
    out = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        out[root(k)].append(i)
    return out


def near_rows(seed=0):
    r = random.Random(seed)
    base = [[f"{r.choice('abcdefgh')}{r.randint(0, 400)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for k in range(150):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
            w[r.randrange(len(w))] = f"x{k}"
        rows.append((k, " ".join(w)))
    return rows


def classes(rows):
    return sorted(sorted(map(str, ids)) for ids in rows)


def test_near(spark):
    repeats = [(k, "the same line over and over " * n + f"then another one of its own {k}") for k, n in enumerate((20, 22, 24, 40, 44, 3, 3, 90))]
    repeats += [(10 + k, "a b c d e f " * 30 + " ".join(f"u{k}v{i}" for i in range(20))) for k in range(4)]  # much of one line, and little in common
    for rows in (near_rows(), HARD, repeats, [(1, "only four words here"), (2, "only four words here!"), (3, "!!!"), (4, "???"), (5, "!!!")]):
        got = defaultdict(list)
        out = near_dup.classes_of(docs(spark, rows, ["key", "node", "label", "row", "mark", "want", "id"])).collect()
        assert len(out) == len(rows)
        want = brute_classes(rows)
        by_want = {str(sorted(map(str, ids))): ids for ids in want.values()}
        for r in out:
            got[r["class_id"]].append(r["doc_id"])
        if rows is not HARD:
            assert classes(got.values()) == classes(want.values())
        for ids in by_want.values():
            known = [i for i in ids if i is not None]
            assert (min(known) if known else None) in got
        assert sum(r["kept"] for r in out) == len(want)
        kept = near_dup.keep_one(docs(spark, rows, ["kept", "__id"]))
        assert kept.count() == len(want) and kept.columns[:5] == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert near_dup.classes_of(docs(spark, [])).count() == 0


def test_common_counts(monkeypatch):
    monkeypatch.setattr(near_dup, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 40, 200, 90, 40, 250)]
    got = near_dup.common_counts(sets[:4], sets[2:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[2:]] for a in sets[:4]]


def test_near_at_the_edge_of_the_threshold(spark):
    """Pairs in one bucket are decided exactly: many of similarity just below and just above 0.8, and none of them by their darts alone."""
    r, rows = random.Random(8), []
    for k in range(60):
        w = [f"b{k}x{i}" for i in range(104)]
        v = list(w)
        v[: r.choice([5, 6, 7, 11, 12])] = [f"c{k}y{i}" for i in range(11)][: r.choice([5, 6, 7])]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
    got = defaultdict(list)
    for x in near_dup.classes_of(docs(spark, rows)).collect():
        got[x["class_id"]].append(x["doc_id"])
    want = classes(brute_classes(rows).values())
    missed = [c for c in want if c not in classes(got.values())]
    assert len(missed) <= 1 and all(len(c) == 1 or c in want for c in classes(got.values()))


def test_near_open_buckets(spark, monkeypatch):
    """Links that the pivots miss: a chain of texts, each near the next, with small cells so that a bucket is cut."""
    monkeypatch.setattr(near_dup, "CELL", 3)
    w = [f"v{i}" for i in range(120)]
    rows = []
    for k in range(12):
        w = list(w)
        w[k * 9] = f"n{k}"
        rows.append((k, " ".join(w)))
    got = near_dup.classes_of(docs(spark, rows)).collect()
    want = brute_classes(rows)
    assert len({r["class_id"] for r in got}) == len(want) == 1


def test_darts():
    rng = np.random.default_rng(0)
    for n, same_share in ((5, 0.6), (60, 0.8), (3000, 0.5)):
        agree = []
        for _ in range(40):
            common = int(n * 2 * same_share / (1 + same_share))
            e = rng.integers(0, 2**63, 2 * n - common).astype(np.uint64)
            a, b = dart_minhash.signatures([e[:n], e[n - common :]], 64)
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - common / (2 * n - common)) < 0.05
    e = rng.integers(0, 2**63, 80).astype(np.uint64)
    w1 = rng.random(80) * 3 + 0.05
    w2 = w1 * rng.choice([1, 0.4], 80)
    agree = []
    for k in range(40):
        a, b = dart_minhash.signatures([e + np.uint64(k), e + np.uint64(k)], 64, [w1, w2])
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()) < 0.05
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 40, 700, 1, 5000)]
    whole = dart_minhash.signatures(sets, 32)
    assert all((dart_minhash.signature(s, 32) == row).all() for s, row in zip(sets, whole, strict=True))
    assert not len(dart_minhash.signatures([], 8))


# --- language ---


def test_language(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(rows)
    out = language_id.predict(rows, model).join(rows.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert max(np.bincount([model.languages.index(x) for x in model.languages])) > 1  # several centroids of a language
    hard = language_id.predict(docs(spark, HARD, ["score", "take", "held_out", "lang_pred"]), model).collect()
    assert len(hard) == len(HARD)
    for r in hard:
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] in model.languages or r["lang_pred"] == "und")
    none = language_id.predict(docs(spark, [(1, None), (2, ""), (3, "12 !? 34")]), model).collect()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 and r["rejected"] for r in none)
    kept = language_id.keep_known(rows.withColumn("score", F.lit(1)), model)
    assert kept.columns == [*rows.columns, "score"] and kept.count() >= 0.98 * rows.count()
    hot = rows.filter("lang = 'en'").limit(1).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("k")
    many = language_id.fit(rows.unionByName(hot).unionByName(rows.select("doc_id", "text", F.concat(F.lit("zz"), F.col("doc_id")).alias("lang"), "source", "n_chars")), languages=4)
    assert sorted(set(many.languages)) == sorted(set(model.languages))  # a repeated row is one of the sample; rare labels are beyond the bound
    empty = language_id.fit(docs(spark, []))
    assert language_id.predict(docs(spark, [(1, "word")]), empty).first()["lang_pred"] == "und"
    assert language_id.predict(docs(spark, []), model).count() == 0


def test_language_learns_from_the_right_rows(spark):
    """Changing text and lang of held-out rows, or source and doc_id order, changes no prediction."""
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    a = language_id.fit(rows)
    b = language_id.fit(rows.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string")))
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids) and np.array_equal(a.idf, b.idf)


def test_language_rejects_what_it_has_not_learned(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(rows)
    r = random.Random(1)
    letters = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(50))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. "
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. "
    strange = [letters, letters * 10, base64.b64encode(r.randbytes(300)).decode(), polish, polish * 20, finnish, "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(500))]
    assert model.predict(strange)[2].all()
    clean = [x["text"] for x in rows.filter("text IS NOT NULL").collect()]
    assert model.predict(clean)[2].mean() <= 0.005


def test_addresses_with_very_many_zeros():
    """Python refuses to turn more than 4,300 digits into a number."""
    long = "0" * 5000
    assert pii_rules.base_spans(f"a {long}.1.2.3 b") == [(2, 5008, "ip")]
    assert pii_rules.base_spans(f"{long}.0.0.0") == [(0, 5006, "ip")]
    assert pii_rules.base_spans(f"{long}256.1.2.3") == [] == pii_rules.base_spans("1" * 5000 + ".1.2.3")


def test_ngrams_of_cut_texts():
    t = "Über das Wort " * 90_000  # longer than a chunk
    whole = language_id.ngram_counts([t])[0]
    assert (language_id.ngram_counts(["x", t, "y"])[1] == whole).all() and whole.sum() > len(t) * 2


# --- packing ---


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe.default_path())


def test_bpe_ids():
    t, e = library(), byte_bpe.encoder(byte_bpe.default_path())
    r = random.Random(1)
    some = ["'s", "'re", "'ll", "'", "''", " ", "  ", "\n", " \n", "\t", "a", "bc", "é", "1", "²", "!", "..", "’", " ", "😀", "漢字", "<|endoftext|>", "\x1c", "_", "don't", "'S", "x" * 300]
    for _ in range(3000):
        x = "".join(r.choice(some) for _ in range(r.randint(0, 12)))
        assert e.encode([x, "'s", x])[2].tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
    assert e.encode([LONG])[0].tolist() == t.encode(LONG, add_special_tokens=False).ids


def check_packing(rows, texts, capacity=packing.CAPACITY):
    t = library()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(by_doc.pop(i), key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in own] == [(k, a, n) for k, (a, n) in enumerate(packing.cut_ids(len(ids), capacity))]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == capacity for r in own[1:])
    assert not by_doc
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq)


def test_packing(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    out = packing.pack(packing.pieces(rows)).collect()
    n = check_packing(out, {r["doc_id"]: r["text"] for r in rows.collect()})
    assert n <= math.ceil(sum(r["length"] for r in out) / packing.CAPACITY) + 1
    hard = {i: t for i, t in HARD if i not in (1, None)} | {20: "<|endoftext|> x"}
    out = packing.pack(packing.pieces(docs(spark, list(hard.items()), ["block", "row", "length"])), block=3).collect()
    check_packing(out, hard)
    twice = packing.pack(packing.pieces(docs(spark, [(1, "a"), (1, "a"), (None, None)]))).collect()
    assert len(twice) == 3 and sum(r["length"] for r in twice) == 5
    assert packing.pack(packing.pieces(docs(spark, []))).count() == 0


def test_sum_of_squares_rule():
    """Each placement against a plain search over all open bins."""
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 40, 300)
    bins, offsets = packing.sum_of_squares(sizes, 40)
    gaps, order = {}, np.argsort(-sizes, kind="stable")
    for i in order:
        s, b = int(sizes[i]), int(bins[i])
        count = defaultdict(int)
        for g in gaps.values():
            count[g] += bool(g)
        if b in gaps:
            g = gaps[b]
            cost = lambda x, s=s, count=count: sum((count[h] - (h == x) + (h == x - s)) ** 2 for h in {*count, x - s} if h)
            assert cost(g) == min(cost(x) for x in set(gaps.values()) if x >= s)
        else:
            assert all(g < s for g in gaps.values())
            g = 40
        assert offsets[i] == 40 - g
        gaps[b] = g - s
    plain: list[int] = []  # no worse than best fit, largest first, by more than one
    for s in -np.sort(-sizes):
        k = bisect.bisect_left(plain, s)
        bisect.insort(plain, (plain.pop(k) if k < len(plain) else 40) - s)
    assert len(gaps) <= len(plain) + 1


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(t):
    out = []
    for k, p in PATTERNS.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            fine = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and pii_rules.luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if fine:
                out.append((m.start(), list(PATTERNS).index(k), m.end(), k))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_base_spans():
    r = random.Random(3)
    some = ["1", "23", "4", "0", ".", "@", "a", "-", " ", "+", "(", ")", "b.c", "%", "255", "4111111111111111", " 1", "é", "٣"]
    for _ in range(20000):
        t = "".join(r.choice(some) for _ in range(r.randint(1, 25)))
        assert pii_rules.base_spans(t) == brute_spans(t), repr(t)


def test_field_learns_and_decodes():
    field = pii.trained()
    fresh = pii.generated(120, seed=99)
    assert sum(field.best(t) == gold for t, gold in fresh) >= 114
    text = "call (743) 555-3824; ssn 123-45-6789, IBAN DE89 3704 0044 0532 0130 00, joe (at) example (dot) com. order 123456789 on 2024-01-02 10:20"
    base, spans = pii.all_spans(text, field)
    assert base == [] and [(k, text[a:b]) for a, b, k in spans] == [("local_phone", "(743) 555-3824"), ("national_id", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("hidden_email", "joe (at) example (dot) com")]


def test_field_against_all_segmentations():
    labels = ["O", "A", "B"]
    f = semi_crf.Field(labels, lambda t, a, b: [t[a:b], str(b - a)] if t[a:b].isdigit() or b - a == 3 else None, lambda t, a, b: [t[a:b]])
    f.train([("1 2", [(0, 1, "A")]), ("x 3", [(2, 3, "B")])], 2, 0.3, 0.01)
    rng = np.random.default_rng(0)

    def all_ways(x):
        """(score, entities) of every segmentation."""
        scores, n = f.scores(x), len(x.tokens)

        def walk(i, label, total, found):
            if i == n:
                yield total, found
            for k in range(len(x.start)):
                if i < n and x.start[k] == i:
                    for y in np.flatnonzero(np.isfinite(scores[k])).tolist():
                        entity = [(x.tokens[i][0], x.tokens[x.end[k] - 1][1], labels[y])] if y else []
                        yield from walk(x.end[k], y, total + f.t[label, y] + scores[k, y], found + entity)

        return list(walk(0, 0, 0.0, []))

    def loss(x):
        """-log p of the segmentation without entities."""
        ways = all_ways(x)
        return np.logaddexp.reduce([w for w, _ in ways]) - next(w for w, found in ways if not found)

    for text in ("1 2 x 3", "3 1", "x x", "1"):
        x = f.lattice(text, learn=True)
        f.w, f.t = rng.normal(size=(len(f.index), 3)), rng.normal(size=(3, 3))
        assert f.best(text) == max(all_ways(x), key=lambda w: w[0])[1]
        dw, dt = f.gradient(x, [])
        for table, slope in ((f.w, dw), (f.t, dt)):
            for at in np.ndindex(table.shape):
                before, old = loss(x), table[at]
                table[at] = old + 1e-6
                assert abs((loss(x) - before) / 1e-6 - slope[at]) < 1e-4
                table[at] = old


def test_regions_give_the_segmentation_of_the_whole_text():
    field, r = pii.trained(), random.Random(11)
    some = [x for x, _ in pii.generated(60, seed=5)] + ["12", "3 4", "a" * 90, "@", "(at)", "\n", " ", "x.y", "٣٤", "_", "1 " * 30, "7" * 100, "é", "+", "(555) 123-4567"]
    for _ in range(400):
        t = "".join(r.choice(some) + r.choice(["", " ", " word and more words to stand between them, until no candidate reaches across any of it " * r.randint(0, 2)]) for _ in range(r.randint(1, 9)))
        assert [x for a, b in pii.regions(t) for x in field.best(t, a, b)] == field.best(t), repr(t)


def test_an_entity_far_into_a_region():
    """No cut: a social security number after thousands of characters that all belong to one region."""
    field = pii.trained()
    for n in (1980, 1995, 2000, 5000):
        t = "ab 1234567 " * (n // 11) + "x" * (n % 11) + " ssn 123-45-6789 and so on"
        assert len(pii.regions(t)) == 1 and [t[a:b] for a, b, k in pii.all_spans(t, field)[1] if k == "national_id"] == ["123-45-6789"]


def test_a_field_over_many_tokens_takes_time_in_proportion():
    field, took = pii.trained(), []
    for n in (1500, 6000):
        began = time.process_time()
        field.best("1 " * n)
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]


def test_pii_query(spark):
    rows = [*HARD, (30, "me@x.org é a@b.co +1 (743) 555-3824, 1.2.3.4, 4111 1111 1111 1111"), (31, "1 " * 2000)]
    out = pii.find(docs(spark, rows, ["spans", "n_ip"])).collect()
    assert len(out) == len(rows)
    r = next(x for x in out if x["doc_id"] == 30)
    base = brute_spans(rows[-2][1])
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (2, 1, 1, 1)
    assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
    assert set(",".join(f"{k}:{a}:{b}" for a, b, k in base).split(",")) <= set(r["spans"].split(","))
    assert all(x["n_pii"] == len([k for k in x["spans"].split(",") if k]) for x in out)
    assert all(x["base_sha256"] == hashlib.sha256(b"").hexdigest() and x["spans"] == "" for x in out if x["doc_id"] in (2, 3))
    clean = pii.redact(docs(spark, rows, ["extra"]))
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"]
    got = {x["doc_id"]: x for x in clean.collect()}
    assert got[30]["text"] == "[EMAIL] é [EMAIL] [PHONE], [IP], [CARD]" and got[30]["n_chars"] == len(got[30]["text"])
    assert got[5]["text"] == LONG and got[2]["text"] is None
    assert pii.find(docs(spark, [])).count() == 0


# --- licenses ---


def brute_licenses(t, templates):
    grams = lambda x: {tuple(w[i : i + 5]) for w in [[p for p in re.split(r"[\W_]+", x.lower()) if p]] for i in range(len(w) - 4)}
    own = grams(t or "")
    return ",".join(sorted(k for k, v in templates.items() if len(own & grams(v)) >= 0.8 * len(grams(v)) - 1e-9))


def test_licenses(spark):
    r = random.Random(5)
    rows = [*HARD, (40, "x. Released under the MIT License.")]
    for k, (_, v) in enumerate(sorted(licenses.TEMPLATES.items())):
        w = v.split()
        edited = list(w)
        edited[r.randrange(len(w))] = "changed"
        rows += [(100 + k, f"start here {v} and go on"), (200 + k, "a b " + " ".join(edited) + " c d"), (300 + k, " ".join(w[: len(w) // 2])), (400 + k, f"{v}\n{v}".upper())]
    out = {x["doc_id"]: x for x in licenses.scan(docs(spark, rows, ["s", "values", "some", "names"])).collect()}
    for i, t in rows:
        if i not in (1, None):
            assert out[i]["licenses"] == brute_licenses(t, licenses.TEMPLATES), t
            assert out[i]["n_licenses"] == len([x for x in out[i]["licenses"].split(",") if x])
    assert licenses.scan(docs(spark, [])).count() == 0


def test_licenses_in_scattered_pieces(spark):
    """A template's shingles one by one, in any order, among foreign words: 0.8 to all of them, against plain containment."""
    r, rows = random.Random(9), []
    for k, v in sorted(licenses.TEMPLATES.items()):
        w = re.findall(r"[^\W_]+", v)
        grams = [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
        for _ in range(6):
            some = r.sample(grams, math.ceil(r.uniform(0.8, 1.0) * len(grams)))
            rows.append((len(rows), " ".join(f"{g} {' '.join(f'q{r.randint(0, 10**6)}' for _ in range(r.randint(1, 9)))}" for g in some)))
    out = {x["doc_id"]: x["licenses"] for x in licenses.scan(docs(spark, rows)).collect()}
    assert all(out[i] == brute_licenses(t, licenses.TEMPLATES) for i, t in rows)
    assert licenses.missed(16) == 0 and max(licenses.missed(m) for m in range(17, 1000)) < 0.0005


# --- pieces ---


def streamed(m, marked, step):
    s, out = pieces.Stream(m), []
    for k in range(0, len(marked), step):
        out += s.feed(marked[k : k + step])
    return out + s.close(), s.most


def test_pieces():
    """Against the library, over whole texts and over one stream for each text."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    e = pieces.encoder(pieces.default_path())
    m, r = e.model, random.Random(2)
    some = ["a", "the", " ", "  ", "\n", "é", "漢字", "😀", "ing", "tion", "\t", "x" * 70, "\0", "<0x0A>", "<s>", "=" * 40, "   "]
    for _ in range(600):
        t = "".join(r.choice(some) for _ in range(r.randint(0, 25)))
        ids = e.encode(["zz", t])[1]
        assert ids.tolist() == sp.encode(t) == streamed(m, (" " + t).replace(" ", pieces.SPACE) if t else "", 7)[0] and m.decode(ids) == t
    assert e.encode([LONG])[0].tolist() == sp.encode(LONG)


def tiny_models():
    r = random.Random(6)
    for n in range(60):
        names = {*("ab" if n % 3 else "a"), *("".join(r.choice("ab▁") for _ in range(r.randint(2, 5))) for _ in range(r.randint(2, 12)))}
        yield r, {p: (float(r.choice([-1, -2, -3, -r.random() * 9])), i) for i, p in enumerate(sorted(names))}


def test_streams_against_all_segmentations():
    """Unigram models: the best sum over all ways to cut a text; BPE models: merging the whole text."""
    for r, score in tiny_models():
        by_score, by_rank = pieces.Model.of(score, False), pieces.Model.of(score, True)
        cost = lambda p: score[p][0] if p in score else by_score.unknown if len(p) == 1 else -math.inf  # noqa: B023, E731
        for _ in range(12):
            t = "".join(r.choice("abc▁") for _ in range(r.randint(1, 11)))
            ways = [[t[i:j] for i, j in itertools.pairwise([0, *cuts, len(t)])] for k in range(len(t)) for cuts in itertools.combinations(range(1, len(t)), k)]
            s = pieces.Stream(by_score)
            s.feed(t)
            tokens = []
            j = len(t)
            while j:
                tokens.append(t[j - s.size[j - 1] : j])
                j -= s.size[j - 1]
            assert sum(map(cost, tokens)) == pytest.approx(max(sum(map(cost, w)) for w in ways))
            s = pieces.Stream(by_rank)
            s.feed(t)
            j, tokens = len(t), []
            while j:
                tokens.append(t[j - s.size[j - 1] : j])
                j -= s.size[j - 1]
            assert tokens[::-1] == by_rank.joined(t)
        t = "".join(r.choice("abc") for _ in range(700))
        whole = {m: streamed(m, t, 701)[0] for m in (by_score, by_rank)}
        assert all(streamed(m, t, 5)[0] == ids for m, ids in whole.items())


def test_the_window_is_bounded():
    m = pieces.encoder(pieces.default_path()).model
    for t in ("a" * 1_000_000, "ab" * 5000, LONG.replace(" ", pieces.SPACE)):
        assert streamed(m, t, 1000)[1] <= 4 * pieces.STEP + 4 * m.longest
    flat = pieces.Model.of({"aa": (-1.0, 0), "aaa": (-1.5, 1), "b": (-1.0, 2)}, False)  # odd and even paths never meet
    ids, held = streamed(flat, "a" * 100_000 + "b" + "a" * 10, 64)
    assert held >= 50_000 and sum(len(flat.text_of[i]) for i in ids) == 100_011


def test_piece_query(spark):
    rows = [x for x in HARD if x[0] not in (1, None)]
    e = pieces.encoder(pieces.default_path())
    out = {x["doc_id"]: x for x in pieces.digests(docs(spark, rows, ["ids", "exact"])).collect()}
    ids = {x["doc_id"]: x["ids"] for x in pieces.encoded(docs(spark, rows)).collect()}
    for i, t in rows:
        own = e.encode([t or ""])[0]
        assert out[i]["n_ids"] == len(own) and out[i]["ids_crc32"] == zlib.crc32(own.astype("<u4").tobytes()) and out[i]["exact"]
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() and ids[i] == own.tolist()
    assert pieces.digests(docs(spark, [])).count() == 0


# --- shards ---


def test_shards(spark):
    store = shards.Store(spark, common.fresh_folder(spark, "t"), target=200_000)
    r = random.Random(0)
    rows = [(i, "".join(r.choice("abcdefghijklmnop") for _ in range(300))) for i in range(3000)]
    first = docs(spark, rows[:1500], ["shard", "tier", "n"]).repartition(5)
    assert store.append(first, most_rows=100) == 1 and store.append(docs(spark, rows[1500:], ["shard", "tier", "n"]).repartition(3), most_rows=100) == 2
    small = store.manifest().count()
    v = store.compact()
    assert v == 3 and store.manifest().count() < small / 3
    assert store.manifest(2).count() == small and store.read(2).count() == 3000  # readers of the older version
    for version in (2, 3):
        assert sorted((x["doc_id"], x["text"]) for x in store.read(version).select("doc_id", "text").collect()) == rows
    assert store.manifest().agg(F.sum("n_rows")).first()[0] == 3000
    sizes = [x["bytes"] for x in store.manifest().collect()]
    assert max(sizes) < 2 * 200_000 and sorted(sizes)[len(sizes) // 2] > 100_000
    assert store.compact() == 3 and store.vacuum() == 0 and store.read(2).count() == 3000  # superseded, but not for long
    assert store.vacuum(0) >= small and store.read().count() == 3000
    with pytest.raises(RuntimeError):
        store.commit(store.manifest(), store.schema(), 2)  # another writer has made version 3
    assert store.version() == 3


def test_shard_query(spark):
    out = shards.placed(docs(spark, HARD, ["shard", "tier"])).collect()
    assert sorted(str((x["doc_id"], x["text_sha256"])) for x in out) == sorted(str((i, hashlib.sha256((t or "").encode()).hexdigest())) for i, t in HARD)
    assert sum(1 / x["shard_rows"] for x in out) == pytest.approx(len({x["shard"] for x in out})) and all(x["shard_rows"] == x["found_rows"] and not x["due"] for x in out)
    assert shards.placed(docs(spark, [])).count() == 0
    sizes = [64 * shards.MB, 32 * shards.MB, 31 * shards.MB, 8 * shards.MB, 5 * shards.MB, 1]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in sizes], "x long").select(shards.tier_of(F.col("x"))).collect()] == [0, 0, 1, 1, 2, 13]


def test_shards_of_two_writers(spark, monkeypatch):
    """vacuum leaves an open append alone; of two commits on one version the later is refused; a lost writer's empty version file is passed over."""
    store = shards.Store(spark, common.fresh_folder(spark, "t"), target=1 << 20)
    store.append(spark.range(10))
    name, entries = store._write(spark.range(10, 20), 1)
    assert store.vacuum(0) == 0
    assert store.commit(store.manifest(1).unionByName(entries), store.schema(), 1) == 2
    store._delete(f"writing/{name}")
    assert store.vacuum(0) == 0 and store.read().count() == 20
    late, others = store._write(spark.range(100, 110), 1)
    with pytest.raises(RuntimeError):
        store.commit(store.manifest(1).unionByName(others), store.schema(), 1)
    assert store.read().count() == 20
    store._delete(f"writing/{late}")
    assert store.vacuum(0) > 0 and store.read().count() == 20
    assert store._create("versions/v00000003", "") and store.version() == 2
    with pytest.raises(RuntimeError):
        store.append(spark.range(20, 30))  # someone may be writing it
    monkeypatch.setattr(shards, "GRACE", -1.0)
    assert store.append(spark.range(20, 30)) == 4 and store.read().count() == 30


def test_shards_are_merged_in_steps(spark, monkeypatch):
    monkeypatch.setattr(shards, "STEP", 3)
    store = shards.Store(spark, common.fresh_folder(spark, "t"), target=1 << 20)
    store.append(spark.range(100).repartition(2), most_rows=5)
    store.compact()
    assert sorted(r["id"] for r in store.read().collect()) == list(range(100)) and store.manifest().count() < 20


def test_shards_of_appends_with_other_columns(spark):
    store = shards.Store(spark, common.fresh_folder(spark, "t"), target=1 << 20)
    for k in range(8):  # the first half lacks a column
        rows = spark.range(k * 10, k * 10 + 10).repartition(1)
        store.append(rows.withColumn("more", F.col("id") * 2) if k >= 4 else rows)
    assert store.compact() == 9
    store.vacuum(0)
    assert sorted((x["id"], x["more"]) for x in store.read().collect()) == [(i, i * 2 if i >= 40 else None) for i in range(80)]
    for wrong in (F.lit("text").alias("more"), F.lit(1).cast("long").alias("More")):
        with pytest.raises(ValueError):
            store.append(spark.range(1).select("id", wrong))
    assert store.version() == 9


# --- chat ---

TURNS = "conv_id long, turn long, role string, text string"


def test_chat(spark):
    r = random.Random(4)
    some = ["\\", "### ", "</turn>", "\n", "#", "a", "é😀", "assistant", ": ", " "]
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, 5, "a:#<\\b", "\\### </turn>"), (None, 0, "assistant", ""), (3, None, "assistant", "q"), (3, 0, "assistant", "q"), (3, 0, "assistant", "q")]
    rows += [(10 + i // 4, i % 4, r.choice(["user", "assistant", "assis: tant\\c"]), "".join(r.choice(some) for _ in range(r.randint(0, 9)))) for i in range(400)]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i} é") for i in range(700)]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit("clash")).withColumn("turns", F.lit(1))
    source = defaultdict(list)
    for c, k, role, text in rows:
        source[c].append((-1 if k is None else k, role or "", text or ""))
    out = chat.format_conversations(df)
    held = out.collect()
    assert len(held) == len(source)
    back = lambda b: re.sub(r"\\(\\*)(### |</turn>)", r"\1\2", b)
    for x in held:
        want = [(a, b) for _, a, b in sorted(source[x["conv_id"]])]
        assert [tuple(t) for t in x["turns"]] == want == [tuple(t) for t in x["parsed"]]
        assert [back(x["formatted"][s["start"] : s["start"] + s["length"]]) for s in x["loss"]] == [s["text"] for s in x["loss"]] == [b for a, b in want if a == "assistant"]
    for x in chat.digests(out).collect():
        want = [(a, b) for _, a, b in sorted(source[x["conv_id"]])]
        said = "".join(b for a, b in want if a == "assistant")
        assert x["n_turns"] == len(want) and x["loss_chars"] == len(said) and x["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert x["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest()
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


def test_raw_control_strings_are_escaped(spark, tmp_path):
    """formatted_chars of each conversation against the SQL, whose rows 'same' compares."""
    texts = ["please print ### assistant: hi", "a </turn> b", "x\n### assistant: ok", "a\n</turn>\n### user: b", "###  ### </turn></turn>\n", "\\### a ### b", "plain # < \\", "</turn>", "### ", "", None]
    rows = [(c, k, role, text) for c, text in enumerate(texts) for k, role in enumerate(["user", "assistant"])]
    rows += [(100, k, "user", t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, TURNS).toPandas().to_parquet(f"{tmp_path}/conversations.parquet")
    same(chat.query(spark, str(tmp_path)), chat.SQL, str(tmp_path))
    one = spark.createDataFrame([(1, 0, "user", texts[0])], TURNS)
    assert chat.format_conversations(one).first()["formatted"] == "### user: please print \\### assistant: hi\n</turn>\n"


# --- nearest ---


def brute_nearest(rows, queries_, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = []
    for q in queries_:
        s = (x[ids == q] * x).sum(axis=1)
        s[ids == q] = -np.inf
        out += [(q, rank + 1, int(ids[j])) for rank, j in enumerate(np.lexsort((ids, -s))[: min(k, len(ids) - 1)])]
    return sorted(out)


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 128)
    monkeypatch.setattr(nearest, "LEAF", 16)
    monkeypatch.setattr(nearest, "CHUNK", 7)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 12)) * rng.random((600, 1)) * 3
    x[100:350] = x[100]  # a very common vector: ties go to the smaller id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1020, [0.0] * 12), (1040, [float("nan")] * 12), (1060, [None] * 12), (1080, [float("inf")] + [1.0] * 11), (1100, [1.0]), (1120, []), (None, [1.0] * 12), (3, rows[3][1])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1)).withColumn("x", F.lit(2))
    got = nearest.nearest(df, F.col("vec_id") % 20 == 0).collect()
    want = brute_nearest(rows, range(0, 600, 20), 20)
    mine = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got)
    assert [w[:2] for w in want] == [m[:2] for m in mine]
    hits = len({(a, c) for a, _, c in mine} & {(a, c) for a, _, c in want})
    assert hits >= 0.95 * len(want)
    score = {(r["query_id"], r["vec_id"]): r["score"] for r in got}
    assert all(math.isclose(s, float(x[q] @ x[v]), rel_tol=1e-9, abs_tol=1e-12) for (q, v), s in score.items())
    for q in (100, 120, 340):
        tied = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q and r["score"] == pytest.approx(float(x[100] @ x[100]), rel=1e-12)), key=lambda r: r["rank"])]
        assert tied == sorted(tied)
    few = nearest.nearest(spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in few) == brute_nearest(rows[:5], [0], 20)
    for empty in ([], [(1000, None)], [(1, [1.0])]):
        assert nearest.nearest(spark.createDataFrame(empty, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square():
    assert nearest.chi2_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3) and nearest.chi2_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)


def test_recall(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {(r["query_id"], r["vec_id"]) for r in nearest.query(spark, SF).collect()}
    want = brute_nearest(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert len(got & {(a, c) for a, _, c in want}) >= 0.9 * len(want)


def test_nearest_keeps_rows_with_one_id(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 64)
    x = np.random.default_rng(3).normal(size=(300, 8))
    ids = [i // 2 for i in range(300)]  # each id holds two different vectors
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = nearest.nearest(df, F.col("vec_id") % 20 == 0, 5).collect()
    want = []
    for n in [n for n in range(300) if ids[n] % 20 == 0]:
        s = x @ x[n]
        s[n] = -np.inf
        want += [(ids[n], rank + 1, ids[j], round(float(s[j]), 9)) for rank, j in enumerate(np.argsort(-s)[:5])]
    mine = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got]
    assert len(mine) == len(want) and len(set(mine) & set(want)) >= 0.95 * len(set(want))


def test_nearest_ties_between_different_vectors(spark, monkeypatch):
    """Of distinct vectors with one score the smallest ids stay, within a leaf, across leaves and across blocks."""
    rng = np.random.default_rng(5)
    for block, leaf in ((4096, 4096), (4096, 64), (256, 64)):
        monkeypatch.setattr(nearest, "BLOCK", block)
        monkeypatch.setattr(nearest, "LEAF", leaf)
        monkeypatch.setattr(nearest, "CONFIDENCE", 1 - 1e-12)  # all is verified
        angle = rng.random(1500) * 6.28
        x = np.stack([np.ones(1500), np.cos(angle) * 1e-3, np.sin(angle) * 1e-3], axis=1)
        ids = rng.permutation(np.arange(1, 1501)) * 20 + 1
        rows = [(0, [1.0, 0.0, 0.0]), *zip(ids.tolist(), x.tolist(), strict=True)]
        got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
        assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(k, v, 1.0) for k, v in enumerate(sorted(ids.tolist())[:20], 1)]
