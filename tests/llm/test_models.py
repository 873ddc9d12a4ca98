"""Embedding links, license scans, toxicity and language ID."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulwise.llm import language_id, license_scan, toxicity, vectors
from tests.llm import brute
from tests.llm.conftest import by_row

NAN, INF = float("nan"), float("inf")


def links_by_hand(rows, threshold):
    def unit(v, label, vec_id):
        if v is None or label is None or vec_id is None or not v or any(x is None or not np.isfinite(x) for x in v):
            return None
        x = np.array(v, float)
        if not x.any():
            return None
        x = x / np.abs(x).max()  # very large and very small numbers too
        return x / np.linalg.norm(x)

    units = [unit(v, label, i) for i, v, label in rows]
    linked = lambda a, b: (units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2]
                           and len(units[a]) == len(units[b]) and float(units[a] @ units[b]) >= threshold)
    n = len(rows)
    roots = brute.classes(n, linked)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        low = min(rows[j][0] for j in range(n) if roots[j] == roots[i]) if vec_id is not None else None
        out.append((vec_id, sum(linked(i, j) for j in range(n) if j != i), low, None if low is None else vec_id == low))
    return out


@pytest.mark.parametrize("interval", [4096, 16])
def test_vector_links(spark, interval):
    rng = np.random.default_rng(interval)
    centres = rng.normal(size=(9, 6))
    rows = [(i, (centres[rng.integers(9)] + rng.normal(size=6) * 0.12).tolist(), int(rng.integers(2))) for i in range(160)]
    same = rows[0][1]
    rows += [(1000 + i, same, rows[0][2]) for i in range(20)] + [(2000, [2 * x for x in same], rows[0][2])]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 6, 0), (3003, [NAN] + same[1:], 0), (3004, [INF] + same[1:], 0),
             (3005, [None] + same[1:], 0), (3006, same, None), (None, same, 0), (3007, same[:3], 0), (3008, same[:3], 0),
             (3009, [1e-200, 0.0], 1), (3010, [1e200, 0.0], 1), (3010, [1e200, 0.0], 1)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    found = vectors.near_duplicates(table.repartition(4), 0.98, interval=interval)
    assert by_row(found, "vec_id", "n_links", "component_id", "kept") == sorted(links_by_hand(rows, 0.98), key=repr)


def test_distant_intervals_are_never_paired(spark):
    """One label, clustered vectors, ranges cut into many intervals: few pairs are kept, and all that hold links."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(150, 64))
    x = centres[rng.integers(150, size=4000)] + rng.normal(size=(4000, 64)) * 0.08
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    eps = math.sqrt(0.04)
    nodes = vectors.unit_rows(table, "vec_id", "embedding", "label").selectExpr(
        "vec_id AS node", "label", "size", "unit", "1L AS copies").repartition(4)
    nodes = nodes.checkpoint()
    rotations = spark.sparkContext.broadcast(vectors._rotations(nodes))
    blocks = vectors._intervals(nodes, rotations, eps, 40).checkpoint()
    held = {r.block: np.frombuffer(r.nodes, np.int64).tolist() for r in blocks.collect()}
    assert len(held) >= 100 and max(map(len, held.values())) <= 40 and sum(map(len, held.values())) == 4000
    per_part = blocks.groupBy("part").count().agg({"count": "max"}).first()[0]
    assert per_part > 5  # a range holds many intervals
    kept = {(r.a, r.b) for r in vectors._pairs(blocks, eps).collect()}
    of = {n: b for b, nodes_ in held.items() for n in nodes_}
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = np.argwhere(np.triu(units @ units.T, 1) >= 0.98)
    assert len(linked) > 1000
    assert {tuple(sorted((of[int(i)], of[int(j)]))) for i, j in linked} <= kept
    every = len(held) * (len(held) + 1) // 2
    by_cells = vectors._pairs(blocks, 1e9).count()
    print("interval pairs", every, by_cells, len(kept))
    assert len(kept) < every / 2 and len(kept) < by_cells * 0.75
    found = vectors.near_duplicates(table, 0.98, interval=40).agg({"n_links": "sum"}).first()[0]
    assert found == 2 * len(linked)


def test_vectors_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_duplicates(none).count() == 0


def test_distant_halves_are_skipped(monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x[np.lexsort(np.floor(x / 0.2).T[::-1])]
    i, j = vectors.close_pairs(x, x, x, x, True, 0.98, 0.2)
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(x @ x.T, 1) >= 0.98))}
    assert set(zip(i.tolist(), j.tolist())) == want


def base_by_hand(text):
    words, starts, labels = brute.alnum(text), [], set()
    for phrase, label in license_scan.PHRASES:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i:i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_license_phrases(spark, no_docs):
    rng = random.Random(4)
    bits = ["MIT", "mit", "License", "license", "Apache", "GENERAL", "public", "x", "Key", "LICENİSE", "é", "general-public"]
    rows = [(i, rng.choice(["", "--"]) + rng.choice([" ", "\n", ", "]).join(rng.choice(bits) for _ in range(rng.randint(0, 40))))
            for i in range(150)]
    rows += [(200, None), (201, ""), (None, "MIT license"), (None, "MIT license"), (202, "mit license"), (202, "mit license"),
             (203, "mit license " * 3000), (204, "mitlicense"), (205, "!mit!license!")]
    table = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, words int, id int").repartition(3)
    found = license_scan.scan(table)
    want = [(d, *base_by_hand(t)) for d, t in rows]
    assert by_row(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    assert license_scan.scan(no_docs).count() == 0


def test_license_notices(spark):
    for text, label in license_scan.NOTICES:
        words = text.split()
        cut = words[:9] + ["one", "two"] + words[9:]
        rows = [(1, "Before. " + text.upper() + " after"), (2, " ".join(cut)), (3, " ".join(words[:len(words) // 2])),
                (4, " ".join(reversed(words))), (5, " ".join(w + " filler words here" for w in words))]
        found = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert label in found[1].labels.split(",") and found[1].score == 1.0
        if len(words) > 20:
            assert label in found[2].labels.split(",")
        for i in (3, 4, 5):
            assert found[i].labels == found[i].base_labels and 0 <= found[i].score <= 1


def test_license_notices_with_a_word_put_in(spark):
    rows, want = [], {}
    for text, label in license_scan.NOTICES:
        words = text.split()
        tail = " " + " ".join(words[-5:])  # the notice's end once more does not undo the match
        for i in range(len(words) + 1):
            for more in ("", tail):
                want[len(rows)] = label
                rows.append((len(rows), "Some text. " + " ".join(words[:i] + ["inserted"] + words[i:]) + more))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lost = [rows[r.doc_id][1] for r in license_scan.scan(docs).collect() if want[r.doc_id] not in r.labels.split(",")]
    assert lost == []


def test_license_weak_diagonals_alone_are_noise(spark):
    texts = ["this source code form", "this is public domain", "subject to the terms x y z w v u t s r q this source code form"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [(r.labels, r.score) for r in license_scan.scan(docs).collect()] == [("", 0.0)] * 3


def notice_by_hand(words, notice):
    """Share of the notice's 3-grams in the fullest stretch of 1.3 of its length (one chain of diagonals), or None."""
    grams, places = [tuple(notice[i:i + 3]) for i in range(len(notice) - 2)], {}
    for at, g in enumerate(grams):
        places.setdefault(g, []).append(at)
    found = [(p, at) for p in range(len(words) - 2) for at in places.get(tuple(words[p:p + 3]), ())]
    drift, chains = max(4, len(notice) // 16), []
    for p, at in sorted(found, key=lambda m: m[0] - m[1]):
        if chains and p - at - (chains[-1][-1][0] - chains[-1][-1][1]) <= drift:
            chains[-1].append((p, at))
        else:
            chains.append([(p, at)])
    reach = math.floor(len(notice) * 1.3) - 3
    best = [max(len({at for q, at in c if p <= q <= p + reach}) for p, _ in c) / len(grams) for c in chains
            if len({at for _, at in c}) >= 3]
    return max(best, default=None)


def test_license_notices_of_any_length(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)]
    lengths = {"short": 12, "page": 150, "whole": 1500}
    notices = {name: [rng.choice(vocabulary) for _ in range(n)] for name, n in lengths.items()}
    table = spark.createDataFrame([(" ".join(w).upper(), name) for name, w in notices.items()]
                                  + [(" ".join(notices["page"]), "page"), (None, "none"), ("one two", "small"), ("", "empty"),
                                     (" ".join(notices["page"]), None)], "text string, label string")
    rows = []
    for name, words in notices.items():
        n = len(words)
        noise = lambda k: [rng.choice(vocabulary) for _ in range(k)]
        rows += [noise(30) + words + noise(30), words[:n // 3] + noise(n // 20) + words[n // 3:], words[:n // 2],
                 words[n // 2:] + words[:n // 2], words[:n // 10] + words[n // 4:], [x for w in words for x in (w, "of")],
                 words + noise(5) + words, words[:n // 2] + noise(n // 3) + words[n // 2:], noise(200),
                 [w if rng.random() > 0.04 else "changed" for w in words]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in license_scan.scan(docs, notices=table).collect()}
    assert len(got) == len(rows)
    hits = 0
    for i, words in enumerate(rows):
        cover = {name: notice_by_hand(words, notice) for name, notice in notices.items() if name != "short"}
        sure = {name for name, c in cover.items() if c is not None and c >= 0.8}
        assert {x for x in got[i].labels.split(",") if x} - {"short"} == sure, i
        hits += len(sure)
        if sure:
            assert got[i].score == max(cover[name] for name in sure)
    assert hits == 8  # whole, with words put in, twice, and with words changed: each of both
    for name, at in (("short", 0), ("page", 10), ("whole", 20)):
        assert [name in got[at + j].labels for j in (0, 2, 5, 6, 8)] == [True, False, False, True, False]
    low = {(r.id, r.label): r.low for r in license_scan.notice_spans(license_scan.votes(
        docs.select(docs.doc_id.alias("id"), F.lit(0).alias("text_hash"), license_scan.words_of(docs.text).alias("words")),
        license_scan.templates(spark, table))).where("verified").collect()}
    assert low[10, "page"] == 30 and low[20, "whole"] == 30


def test_license_templates_that_are_no_notices(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "MIT License and more words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "body string, name string")
    found = license_scan.scan(docs, notices=none, notice_col="body", label_col="name")
    assert by_row(found, "doc_id", "labels", "n_base") == [(1, "mit", 1), (2, "", 0)]
    monkeypatch.setattr(license_scan, "BROADCAST_POSITIONS", 0)  # joined by gram, whatever the plan
    table = spark.createDataFrame([("and more words stand here", "own")], "text string, label string")
    more = spark.createDataFrame([(3, "x And more words\nstand here.")], docs.schema).union(docs)
    assert by_row(license_scan.scan(more, notices=table), "doc_id", "labels") == [(1, "mit"), (2, ""), (3, "own")]


def test_license_plan_has_no_python(spark, tricky):
    plan = license_scan.scan(tricky[1])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def made_up(rng, toxic):
    syllables = ["ba", "ke", "lo", "mi", "tu", "ren", "so", "dal"]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
    for _ in range(rng.randint(2, 4) if toxic else 0):
        words.insert(rng.randrange(len(words)), rng.choice(["grobbish", "vexling", "snurfed"]))
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    rows = [(i, made_up(rng, i % 7 == 0), int(i % 7 == 0)) for i in range(900)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, ""), (None, "x"), (0, rows[0][1])],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (None, 1), (0, 0), (5000, 1)],
                                   "doc_id long, toxic int").where(~language_id.held_out("doc_id"))
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs.withColumn("score", F.lit(1)), model)
    assert found.columns == ["doc_id", "text", "score", "_score"]
    scored = found.withColumn("held", language_id.held_out("doc_id")).collect()
    assert len(scored) == 904 and all(0 <= r._score <= 1 for r in scored)
    held = [(r._score >= 0.3, r.doc_id % 7 == 0) for r in scored if r.held and r.doc_id < 900]
    assert len(held) > 150 and sum(a == b for a, b in held) / len(held) > 0.97


def cells_by_hand(text):
    """Cells of the distinct 3-5-grams of a text, each n-gram hashed alone."""
    low = "".join(c if ord(c) >= 0x250 else c.lower() if len(c.lower()) == 1 and c.lower().isalnum() else " "
                  for c in f" {text or ''} ")
    cells = set()
    for size in (3, 4, 5):
        for gram in {low[i:i + size] for i in range(len(low) - size + 1)}:
            h = 0
            for c in gram:
                h = (h * 0x01000193 + ord(c)) % 2**32
            h = ((h ^ h >> 15) * 0x85EBCA6B + size) % 2**32
            cells.add((h ^ h >> 13) >> 14)
    return cells


def test_toxicity_by_hand(spark):
    """Ratios and selection counted anew; the fit is checked by the slope of its loss; scores are summed anew."""
    rng = random.Random(21)
    rows = [(i, made_up(rng, i % 4 == 0) + rng.choice(["", " Straße", " 漢字!", "É"]), int(i % 4 == 0)) for i in range(160)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, None), (901, ""), (902, "grobbish")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.learn(docs.repartition(4), labels)
    have = [cells_by_hand(t) for _, t, _ in rows]
    toxic = np.array([y for _, _, y in rows])
    total = [int((toxic == 0).sum()), int((toxic == 1).sum())]
    count = {}
    for cells, y in zip(have, toxic):
        for c in cells:
            count.setdefault(c, [0, 0])[y] += 1
    z = {}
    for c, n in count.items():
        has, lacks = [x + 0.5 for x in n], [t - x + 0.5 for t, x in zip(total, n)]
        odds = math.log(has[1] / lacks[1]) - math.log(has[0] / lacks[0])
        z[c] = abs(odds) / math.sqrt(sum(1 / x for x in has + lacks))
    kept = {c for c in z if z[c] >= toxicity.LEAST_Z}
    assert 20 < len(kept) < toxicity.FEATURES and set(model.cells.tolist()) == kept
    mass = [sum(n[y] + 1 for n in count.values()) + toxicity.CELLS - len(count) for y in (0, 1)]
    ratio = {c: math.log((count[c][1] + 1) / mass[1]) - math.log((count[c][0] + 1) / mass[0]) for c in kept}
    weight = dict(zip(model.cells.tolist(), model.weights.tolist()))
    chance = lambda cells: 1 / (1 + math.exp(-(model.intercept + sum(weight[c] for c in cells if c in kept))))
    error = [chance(cells) - y for cells, y in zip(have, toxic)]
    slope = {c: sum(e for e, cells in zip(error, have) if c in cells) * ratio[c] + toxicity.RIDGE * weight[c] / ratio[c]
             for c in kept}
    at_zero = {c: sum(total[1] / len(rows) - y for y, cells in zip(toxic, have) if c in cells) * ratio[c] for c in kept}
    norm = lambda s: math.sqrt(sum(x * x for x in s.values()))
    assert norm(slope) < norm(at_zero) / 1000 and abs(sum(error)) / len(rows) < 0.002  # the intercept has no ridge
    for r in toxicity.score(docs, model).collect():
        assert r._score == pytest.approx(chance(cells_by_hand(r.text)), abs=1e-9)


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    rng = random.Random(9)
    fit, sizes = toxicity._fit, []
    monkeypatch.setattr(toxicity, "_fit", lambda rows, *rest: sizes.append(len(rows)) or fit(rows, *rest))
    docs = [(i % 4, made_up(rng, i % 2 == 1)) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, toxic int")
    once = spark.createDataFrame(docs, "doc_id long, text string")
    thrice = spark.createDataFrame(docs * 3, "doc_id long, text string")
    toxicity.learn(once, labels, sample_rows=50)
    toxicity.learn(once, labels)
    model = toxicity.learn(thrice, labels)
    assert sizes[0] <= 50 and max(sizes) <= 400
    found = [(r._score >= 0.5, r.doc_id % 2 == 1) for r in toxicity.score(once, model).collect()]
    assert sum(a == b for a, b in found) / len(found) > 0.97


def test_toxicity_without_both_labels(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    for labels, low, high in (([], 0, 0.01), ([(1, 1)], 0.99, 1), ([(1, 0)], 0, 0.01)):
        model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(low <= r._score <= high for r in toxicity.score(docs, model).collect())
        assert toxicity.score(no_docs, model).count() == 0


def test_cells_do_not_depend_on_slices(monkeypatch):
    text = "Straße GROSS é 漢字 abc " * 50
    whole = set(np.concatenate(list(toxicity._cells(text))).tolist())
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 17)
    assert set(np.concatenate(list(toxicity._cells(text))).tolist()) == whole


LANGUAGES = {"aa": ["ba", "be", "bo", "dan", "dol"], "bb": ["ki", "ku", "kra", "xi", "xor"], "cc": ["éz", "ôm", "çu", "zé"]}


def sentence(rng, name, n):
    return " ".join("".join(rng.choice(LANGUAGES[name]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_language_id_on_held_out_rows(spark, no_docs):
    rng = random.Random(3)
    rows = [(i, sentence(rng, lang := rng.choice(list(LANGUAGES)), rng.randint(4, 60)), lang) for i in range(400)]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "123 !? €", "bb"), (503, sentence(rng, "aa", 9), None),
             (None, sentence(rng, "bb", 9), "cc"), (504, "\n".join([sentence(rng, "aa", 40), sentence(rng, "bb", 15)]), None),
             (505, sentence(rng, "cc", 9000), None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, _score int").repartition(3)
    found = language_id.identify(docs)
    got = {r.doc_id: r for r in found.withColumn("held", language_id.held_out("doc_id")).collect()}
    assert len(got) == len(rows)
    held = [r for r in got.values() if r.held and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 70 and all(r._lang_pred == r.lang for r in held)
    assert [got[i]._lang_pred for i in (500, 501, 502)] == ["und"] * 3 and got[502]._score == 0
    assert got[503]._lang_pred == "aa" and got[None]._lang_pred == "bb" and got[505]._lang_pred == "cc"
    assert got[504]._lang_pred == "aa" and 0.6 < got[504]._score < 0.85
    assert language_id.identify(no_docs).count() == 0
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    relabelled = {r.doc_id: r.lang for r in kept.collect()}  # labels that are missing or wrong give way to the prediction
    assert relabelled == {i: r._lang_pred for i, r in got.items() if r._lang_pred != "und"}
    assert not {500, 501, 502} & set(relabelled) and relabelled[503] == "aa" and relabelled[None] == "bb"


def byte_words(text):
    """Trigram cells of each word of a text."""
    normal = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode())
    out = []
    for word in normal.split(b" "):
        padded = b" " + word + b" "
        if word:
            out.append([((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 0x9E3779B1 % 2**32) >> 17
                        for i in range(len(word))])
    return out


def em_by_hand(likely):
    """Proportions for words of the given likelihoods, and the log-likelihood they reach."""
    n = len(likely[0])
    share = [1 / n] * n
    for _ in range(language_id.ROUNDS):
        new = [0.0] * n
        for word in likely:
            whole = sum(s * x for s, x in zip(share, word))
            for k in range(n):
                new[k] += share[k] * word[k] / whole / len(likely)
        moved, share = max(abs(a - b) for a, b in zip(new, share)), new
        if moved <= 1e-3:
            break
    return share, sum(math.log(sum(s * x for s, x in zip(share, word)) + 1e-30) for word in likely)


def language_by_hand(text, names, counts):
    """Language and score of a text by the docstring's method, word by word."""
    log_p = [[math.log((counts[k].get(c, 0) + language_id.SMOOTHING)
                       / (sum(counts[k].values()) + language_id.SMOOTHING * language_id.GRAMS)) for k in names]
             for c in sorted({c for w in byte_words(text) for c in w})]
    log_p = dict(zip(sorted({c for w in byte_words(text) for c in w}), log_p))
    words = [[sum(log_p[c][k] for c in cells) for k in range(len(names))] for cells in byte_words(text)]
    words = [[x - max(w) for x in w] for w in words]
    likely = [[math.exp(max(x, -60)) for x in w] for w in words]
    alone = [sum(w[k] for w in words) for k in range(len(names))]
    best = alone.index(max(alone))
    penalty = language_id.PENALTY * math.log(len(words) + 1)
    share, mixed = em_by_hand(likely)
    if mixed - max(alone) <= penalty:
        return names[best], 1.0
    chosen, value = {best: 1.0}, alone[best]
    left = [k for k in range(len(names)) if share[k] > 0.5 / len(words)]
    while len(left) > 1:
        part, reached = em_by_hand([[w[k] for k in left] for w in likely])
        if reached - penalty * (len(left) - 1) > value:
            chosen, value = dict(zip(left, part)), reached - penalty * (len(left) - 1)
        left.pop(part.index(min(part)))
    top = max(chosen, key=chosen.get)
    return names[top], chosen[top]


def test_language_mixtures_by_hand(spark):
    rng = random.Random(33)
    near = {**LANGUAGES, "dd": ["ba", "be", "ki", "dan", "xi"]}  # shares syllables with two others
    draw = lambda name, n: " ".join("".join(rng.choice(near[name]) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(i, draw(name := sorted(near)[i % 4], rng.randint(3, 50)), name) for i in range(120)]
    learning = [r for r in rows]
    for i in range(60):
        parts = rng.sample(sorted(near), rng.randint(1, 3))
        mixed = " ".join(draw(name, rng.randint(2, 40)) for name in parts).split()
        rng.shuffle(mixed)
        rows.append((1000 + i, rng.choice([" ", ", ", "\n"]).join(mixed).capitalize(), None))
    rows += [(2000, "Zebra qqq", None), (2001, "漢字", None), (2002, None, None)]
    names = sorted(near)
    counts = {name: {} for name in names}
    for _, text, name in learning:
        for c in (c for w in byte_words(text) for c in w):
            counts[name][c] = counts[name].get(c, 0) + 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.learn(spark.createDataFrame(learning, docs.schema).repartition(3))
    assert model[0] == names
    mixtures = 0
    for r in language_id.predict(docs, *model).collect():
        lang, score = language_by_hand(r.text, names, counts) if r.text else ("und", 0.0)
        assert r._lang_pred == lang and r._score == pytest.approx(score, abs=0.01), r.text
        mixtures += score not in (0.0, 1.0)
    assert mixtures > 20


def test_only_und_is_rejected(spark):
    rng = random.Random(6)
    names = "abcdefgh"
    word = lambda name: "".join(rng.choice(name + name.upper()) for _ in range(5)) + name * 3
    rows = [(i, " ".join(word(names[i % 8]) for _ in range(40)), names[i % 8]) for i in range(160)]
    rows += [(500, " ".join(word(name) for name in names for _ in range(60)), None), (501, None, "a"), (502, "12 !?", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mixed = [r for r in language_id.identify(docs).collect() if r.doc_id == 500]
    assert mixed[0]._score < 0.25
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in language_id.keep_identified(docs).collect()} == {501, 502}


def test_language_id_with_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r._lang_pred, r._score) for r in language_id.identify(docs).collect()] == [("und", 0.0)]


def test_trigrams_do_not_depend_on_slices(monkeypatch):
    from haulwise.llm import words
    buf, off = words.flat(pa.array(["ab cd é", "", "x", "yy zz-q"]))
    cells = lambda: [c for part, _ in language_id._trigrams(buf, off) for c in part.tolist()]
    whole = cells()
    monkeypatch.setattr(words, "SLICE_BYTES", 4)
    assert cells() == whole
