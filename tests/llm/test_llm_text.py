"""Dedup, joins and scores of texts against brute force, SQL and planted cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brute import components, exact, repeats
from cohorta.llm import hashing, jaccard_join, lm_scores as ngrams, repeats as suffix, shared, toxicity
from cohorta.llm.decontaminate import align, clean, leaks
from cohorta.llm.exact_dedup import drop_copies, exact_dedup
from cohorta.llm.lm_scores import lm_scores
from cohorta.session import exists, remove, stage
from tools.check_oracles import compare, connect

LONG = " ".join(f"word{k}" for k in range(400))


def table(spark, rows):
    """doc_id and text with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(d, t, "x", d, "y") for d, t in rows], "doc_id long, text string, keep_id string, n long, owner string").repartition(4)


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op4_ngram_jaccard_join", "op8_lm_scores", "op8_lm_scores_order2"])
def test_against_sql(spark, sf, name):
    text, _, _ = compare(spark, connect(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert text.startswith("ok"), text


def test_exact_dedup_splits_heavy_groups(spark):
    rows = [(k, "same  text") for k in range(90)] + [(k, "same text\n") for k in range(90, 120)]
    rows += [(k, f"other {k % 7}") for k in range(120, 150)] + [(150, None), (151, ""), (152, " \t"), (153, LONG)]
    assert by_id(exact_dedup(table(spark, rows), heavy_rows=20)) == exact(rows)
    kept = {r["doc_id"] for r in drop_copies(table(spark, rows)).collect()}
    assert kept == {d for d, v in exact(rows).items() if v[2]}


def test_exact_dedup_without_ids(spark):
    rows = [(None, "a b"), (None, "ab "), (4, "ab"), (4, "ab"), (None, "z"), (None, "z"), (None, " z"), (None, "z ")]
    got = exact_dedup(table(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in got if r["group_size"] == 4) == sorted(
        [("4", "None", 4, False)] * 2 + [("None", "None", 4, True)] * 2 + [("None", "None", 4, True)] * 4)
    # The longest of the first group have no id; of either group one row stays.
    for heavy in (2, 64):
        left = [(r["doc_id"], r["text"]) for r in drop_copies(table(spark, rows), heavy_rows=heavy).collect()]
        assert len(left) == 2 and {t.replace(" ", "") for _, t in left} == {"ab", "z"}
        assert all(d is None and len(t) > 1 for d, t in left)
    twice = drop_copies(table(spark, [(4, "ab"), (4, "ab"), (4, "other"), (5, "a b"), (5, "a b"), (5, "a b"), (6, None)])).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in twice) == [(4, "other"), (5, "a b"), (6, "")]


def test_near_copies_without_ids(spark):
    """A chain over rows without id holds, and one row of a component stays."""
    words = [f"w{k}" for k in range(60)]
    def changed(*at):
        return " ".join("x" + w if k in at else w for k, w in enumerate(words))
    rows = [(3, changed()), (None, changed(0, 1, 2, 3, 4)), (7, changed(0, 1, 2, 3, 4, 56, 57, 58, 59)), (7, "quite another text of the same id"),
            (None, " ".join(f"v{k}" for k in range(30))), (None, " ".join(f"v{k}" for k in range(31))), (None, ""), (None, "one")]
    got = jaccard_join.jaccard_components(table(spark, rows)).filter("n_shingles > 20").collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in got if r["component_id"]) == [("3", 3), ("7", 3), ("None", 3)]
    left = sorted((str(r["doc_id"]), len(r["text"])) for r in jaccard_join.one_of_each(table(spark, rows)).collect())
    assert len(left) == 5 and left[0] == ("3", len(rows[0][1])) and left[1] == ("7", len(rows[3][1]))


def test_stages_tell_rows_apart_by_text(spark):
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    docs = table(spark, [(k, ("vile " if k % 2 else "kind ") + f"words about thing {k}") for k in range(60)]
                 + [(None, "vile words again"), (None, "kind words again"), (29, "kind words once more"), (None, None)])  # 29 is held out
    left = [(r["doc_id"], r["text"]) for r in toxicity.drop_toxic(docs, labels).collect()]
    assert sorted(str(d) for d, _ in left) == sorted([str(k) for k in range(0, 60, 2)] + ["None", "29", "None"])
    assert (29, "kind words once more") in left and (None, "vile words again") not in left
    item = " ".join(f"b{k}" for k in range(20))
    rows = table(spark, [(1, item), (1, "clean"), (None, "x " + item), (None, None), (2, "clean")])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    left = clean(rows, bench)
    assert left.columns == rows.columns and sorted((str(r["doc_id"]), r["text"] or "") for r in left.collect()) == [
        ("1", "clean"), ("2", "clean"), ("None", "")]


def test_scattered_words_are_no_leak(spark):
    item = [f"b{k}" for k in range(100)]
    apart = " ".join(w if k % 2 == 0 or k < 4 else f"n{k}" for k, w in enumerate(item[:26]))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = leaks(table(spark, [(1, apart), (2, "so " + " ".join(item[40:53]) + " end"), (3, " ".join(item[40:52]))]), bench).collect()
    assert [(r["doc_id"], r["matches"]) for r in got] == [(2, 13)]


def noisy_copies(seed):
    rng, rows = random.Random(seed), []
    for _ in range(60):
        base = [rng.choice("abcdefghijkl") for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(1, 6)):
            words = list(base)
            for _ in range(rng.randrange(0, 4) if words else 0):
                k = rng.randrange(len(words))
                words[k:k + 1] = rng.choice([["X"], [], [words[k], "q"]]) or words[k + 1:k + 1]
                if not words:
                    break
            rows.append((len(rows) + 7, " ".join(words)))
    hub = [f"w{k}" for k in range(120)]
    for _ in range(80):
        words = list(hub)
        for k in rng.sample(range(120), rng.randrange(0, 5)):
            words[k] = f"z{rng.randrange(10**6)}"
        rows.append((len(rows) + 7, " ".join(words)))
    rows += [(len(rows) + 7 + k, " ".join(str(rng.random()) for _ in range(60)) + " " + " ".join(hub[:50])) for k in range(40)]
    rows += [(5001, None), (5002, ""), (5003, " \n"), (5004, LONG), (5005, LONG.upper()), (5006, "one two"), (5007, "one  TWO")]
    rng.shuffle(rows)
    return rows


def test_jaccard_components(spark, monkeypatch):
    monkeypatch.setattr(shared, "FLUSH_KEYS", 5000)
    monkeypatch.setattr(shared, "BUCKET_KEYS", 4000)
    rows = noisy_copies(5)
    assert by_id(jaccard_join.jaccard_components(table(spark, rows))) == components(rows)


def test_sketches_rule_out_pairs_and_lose_no_link(spark, monkeypatch):
    """Texts of four passages out of eight share long lists; hardly any two of them link. Without sketches (all alike) the
    last comparison looks at far more pairs and finds the same."""
    monkeypatch.setattr(jaccard_join, "LIST", 3)
    rng, plain, counts = random.Random(6), jaccard_join.compared, []
    pool = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(25)) for _ in range(8)]
    rows = [(k, " ".join(pool[p] for p in rng.sample(range(8), 4))) for k in range(60)]
    rows += [(100 + k, text + " end") for k, text in rows[:5]]

    def counting(pairs, sets):
        counts.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(jaccard_join, "compared", counting)
    want = components(rows)
    assert by_id(jaccard_join.jaccard_components(table(spark, rows))) == want
    drawn = counts[-1]
    monkeypatch.setattr(jaccard_join, "sketched", lambda sets: sets.select(
        "sid", *[F.lit(0).cast("long").alias(f"s{w}") for w in range(jaccard_join.SKETCH)]))
    assert by_id(jaccard_join.jaccard_components(table(spark, rows))) == want
    assert 3 * drawn < counts[-1], (drawn, counts[-1])


def test_sketches_differ_in_no_more_than_their_sets():
    rng = np.random.default_rng(8)
    for n in (1, 5, 300):
        keys = rng.integers(0, 1 << 62, (2, n))
        keys[1, :n // 2] = keys[0, :n // 2]
        x, y = jaccard_join.sketch(pa.array(keys.tolist(), pa.list_(pa.int64())))
        assert sum(int(w).bit_count() for w in (x ^ y).view(np.uint64)) <= 2 * (n - n // 2)


def _hashed(words):
    flat, offsets = hashing.flat_bytes(pa.array(words, pa.string()))
    return hashing.hash_words(flat, offsets[:-1], offsets[1:])


def test_words_without_known_collisions(spark):
    """Sequences that collide under any polynomial modulo 2^64: Thue-Morse words and their complements."""
    words = []
    for k in range(5, 15):
        plain = "".join("ab"[n.bit_count() % 2] for n in range(1 << k))
        words += [plain, plain.translate(str.maketrans("ab", "ba")), plain + "a", plain[:-1]]
    words += ["c" * k for k in (31, 32, 33, 63, 64, 65, 1023, 1024, 1025)]
    assert len(set(_hashed(words).tolist())) == len(words)
    assert _hashed(words[::-1])[::-1].tolist() == _hashed(words).tolist()  # a word's hash is its own, wherever it lies
    rows = list(enumerate(words))
    assert by_id(jaccard_join.jaccard_components(table(spark, rows))) == {k: (1, k) for k, _ in rows}


def test_size_rules():
    for n in range(1, 40):
        for m in range(1, 40):
            links = any(4 * o >= 3 * (n + m - o) for o in range(min(n, m) + 1))
            assert links == (m in jaccard_join.partners(n) and jaccard_join.shared_size(n, m) <= min(n, m))
    assert 0 <= jaccard_join.boundary({2: 1000, 5: 500, 9: 100, 16: 50}) <= jaccard_join.LARGEST_SMALL
    assert jaccard_join.boundary({}) == 0


@pytest.mark.parametrize("shard_bytes", [8 << 20, 3000])
def test_suffix_array_dedup(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(shared, "FLUSH_KEYS", 500)
    monkeypatch.setattr(shared, "BUCKET_KEYS", 400)
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard_bytes)
    rng = random.Random(3)
    parts = ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(40, 140))) for _ in range(8)]
    rows = [(3 * i + 1, "".join(rng.choice(parts)[rng.randrange(20):] if rng.random() < .5 else "".join(
        rng.choice("abcdefgh ") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(6)))) for i in range(90)]
    rows += [(i, "a" * i) for i in range(1000, 1130, 7)] + [(2000, None), (2001, ""), (2002, LONG), (2003, LONG)]
    rng.shuffle(rows)
    assert by_id(suffix.remove_repeats(table(spark, rows))) == repeats(rows)


def test_suffix_array_dedup_on_documents(spark, documents):
    assert by_id(suffix.remove_repeats(table(spark, documents))) == repeats(documents)


def test_suffix_array_dedup_of_repeated_and_missing_ids(spark):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    a, b, c = noise(100), noise(80), noise(70)
    rows = [(1, a + b), (2, c + noise(20)), (None, noise(900) + a), (None, noise(60) + b + noise(60)), (None, noise(90)),
            (5, noise(300) + c), (5, noise(300) + c[:60]), (5, a + noise(40)), (6, noise(40) + b)]
    rows += [rows[2], rows[5], rows[8], (None, a + b), (None, a + b)]
    first, far, want = {}, 1 << 63, []
    for doc, text in rows:
        for k in range(len(text) - 49):
            first[text[k:k + 50]] = min(first.get(text[k:k + 50], far), doc or far)
    for doc, text in rows:
        gone = {i for k in range(len(text) - 49) if first[text[k:k + 50]] < (doc or far) for i in range(k, k + 50)}
        kept = "".join(x for i, x in enumerate(text) if i not in gone)
        want.append((str(doc), len(text), len(gone), sum(i - 1 not in gone for i in gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = suffix.remove_repeats(table(spark, rows)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_segments_of_texts_laid_end_to_end():
    """A batch of texts gives the segments of each text by itself: runs of passages with the same leftmost least run."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é") for _ in range(n)) for n in (0, 49, 50, 51, 0, 300, 7, 80, 0)] + ["a" * 90]
    flat, offsets = hashing.flat_bytes(pa.array(texts, pa.string()))
    wanted = np.sort(suffix.run_hashes(flat))[::2]
    want = []
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        hashes, before = suffix.run_hashes(flat[a:b]).tolist(), None
        for i in range(b - a - suffix.PASSAGE + 1):
            place = min(range(i, i + suffix.WIDTH), key=lambda p: (hashes[p], p))
            if place == before and want and want[-1][0] == k:
                want[-1][3] = a + i
            else:
                want.append([k, hashes[place], a + i, a + i])
            before = place
    want = [tuple(x) for x in want if x[1] in set(wanted.tolist())]
    text, key, first, last = suffix.segments(flat, offsets, wanted)
    assert list(zip(text.tolist(), key.tolist(), first.tolist(), last.tolist())) == want
    assert suffix.pieces_of(flat, first, last + 1).to_pylist() == [flat[i:j + 1].tobytes() for _, _, i, j in want]


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(1)
    text = np.concatenate((rng.integers(97, 99, 3000), np.zeros(suffix.PASSAGE))).astype(np.uint8)
    order, first = suffix.suffix_order(text)
    whole = order <= 3000 - suffix.PASSAGE  # what reaches into the padding is in some order of its own
    keys = [text[k:k + suffix.PASSAGE].tobytes() for k in order[whole]]
    assert keys == sorted(keys) and len(set(keys)) <= first.sum()
    assert all(first[k] or text[order[k]:order[k] + 50].tobytes() == text[order[k - 1]:order[k - 1] + 50].tobytes()
               for k in range(1, len(order)) if order[k] <= 2950 and order[k - 1] <= 2950)


def test_alignment():
    a = np.array([1, 2, 3, 4, 5, 6, 7, 8])
    assert align(a, a) == (16, 8)
    assert align(np.array([9, 1, 2, 3, 9, 4, 5, 6, 7, 8]), a) == (15, 8)      # one word added
    assert align(np.array([1, 2, 3, 9, 5, 6, 7, 8]), a) == (13, 7)            # one word changed
    assert align(np.zeros(0, np.int64), a) == (0, 0)


def test_leaks_finds_edited_copies(spark):
    rng = random.Random(8)
    items = [(k, " ".join(f"b{rng.randrange(3000)}" for _ in range(40))) for k in range(20)] + [(90, "Two words"), (91, None), (92, "")]
    def noise(n):
        return " ".join(f"b{rng.randrange(3000)}" for _ in range(n))
    docs, want = [], set()
    for k in range(120):
        if k % 3 == 0:
            words = items[k % 20][1].upper().split()
            for at in range(k % 7, 40, 7):  # every seventh word is another one
                words[at] = "edited"
            docs.append((k, noise(80) + "\n" + ", ".join(words) + " " + noise(50)))
            want.add((k, k % 20))
        else:
            docs.append((k, noise(200)))
    docs += [(500, "it has two WORDS, indeed"), (501, None), (502, "")]
    want.add((500, 90))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(table(spark, docs), bench).collect()}
    assert got == want
    # However often an item was copied, it is found.
    many = table(spark, [(k, f"start {items[3][1]} end{k}") for k in range(300)])
    assert leaks(many, bench).count() == 300


def test_leaks_finds_an_edit_every_fourth_word(spark):
    """Copies with at most three words in a row, alone and beside others whose runs are rarer."""
    rng = random.Random(4)
    items = [(k, [f"c{rng.randrange(3000)}" for _ in range(40)]) for k in range(8)]
    docs = []
    for k in range(32):
        words = [f"n{k}x{i}" if i % 4 == k // 8 else w for i, w in enumerate(items[k % 8][1])]
        docs.append((k, " ".join([f"d{rng.randrange(3000)}" for _ in range(60)] + words + ["tail"])))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    for some in (docs[:8], docs, docs + docs[8:] * 3):
        got = {(r["doc_id"], r["item_id"]): r["matches"] for r in leaks(table(spark, some), bench).collect()}
        assert got == {(d, d % 8): got.get((d, d % 8)) for d, _ in some} and min(got.values()) >= 29


def test_lm_scores_without_words(spark):
    got = by_id(lm_scores(table(spark, [(1, None), (2, " \n"), (3, "a b"), (None, "a b"), (4, "q")])))
    assert got[1] == got[2] == (0, 0, 0, 0.0)
    assert got[3] == got[None] and got[3][:3] == (2, 1, 1)
    assert got[3][3] == pytest.approx(np.log(1 / 3))  # the word is one of the three others, the pair follows it always
    assert got[4][3] == pytest.approx(np.log(0.16 / 5))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_scores_of_any_order(spark, order):
    rng = random.Random(order)
    rows = [(k, " ".join(rng.choice("aabbcdE") for _ in range(rng.randrange(0, 12)))) for k in range(25)] + [(99, "a b zzz a b c")]
    got = by_id(lm_scores(table(spark, rows), order=order))
    for doc, text in rows:
        rest, words, x, pairs = [t.lower().split() for d, t in rows if d != doc], text.lower().split(), 0.0, 0

        def count(run):
            return sum(w[i:i + len(run)] == run for w in rest for i in range(len(w) - len(run) + 1))

        for i in range(len(words)):
            most = min(order, i + 1)
            size = next((m for m in range(most, 0, -1) if count(words[i - m + 1:i + 1])), 0)
            every = sum(map(len, rest))
            x += np.log(0.4 ** (most - size) * count(words[i - size + 1:i + 1]) / (
                count(words[i - size + 1:i]) if size > 1 else every) if size else 0.4 ** max(most, 2) / (every + 1))
            pairs += size > 1
        assert got[doc][:3] == (len(words), pairs, len(words) - pairs) and got[doc][3] == pytest.approx(x)


def test_lm_scores_in_passes_over_the_key_space(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, " ".join(rng.choice("abcdefghij") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 30)))) for k in range(60)]
    whole = by_id(lm_scores(table(spark, rows)))
    monkeypatch.setattr(ngrams, "GROUP_BYTES", 300)
    monkeypatch.setattr(ngrams, "PARTITION_BYTES", 300)  # a partition for each group of texts
    monkeypatch.setattr(ngrams, "PASSES", 3)
    asked = []
    border = ngrams._border
    monkeypatch.setattr(ngrams, "stage", lambda df, label: (asked.append(label), stage(df, label))[1])
    got = by_id(lm_scores(table(spark, rows)))
    assert asked.count("ngram-totals") == 3
    assert all(got[k][:3] == whole[k][:3] and got[k][3] == pytest.approx(whole[k][3]) for k in whole) and len(got) == 60
    for parts in (1, 2, 3, 7, 1000):  # a partition begins where the one before ends
        keys = np.array([border(k, parts) for k in range(parts)], np.uint64)
        assert border(parts, parts) == 1 << 64
        assert (np.diff(ngrams._parts(keys, parts)) == 1).all()
        assert (np.diff(ngrams._parts(keys[1:] - np.uint64(1), parts))[:-1] == 1).all()


def test_jaccard_join_leaves_no_sets_that_are_done(spark, monkeypatch):
    made = []
    monkeypatch.setattr(jaccard_join, "remove", lambda spark, path: (made.append(path), remove(spark, path))[1])
    rows = [(k, f"{LONG} tail{k % 3}") for k in range(12)] + [(20, "nothing like it " * 5)]
    got = by_id(jaccard_join.jaccard_components(table(spark, rows)))
    assert {got[k][1] for k in range(12)} == {0} and got[20][1] == 20
    assert len(made) == 1 and "likely-sets" in made[0] and not exists(spark, made[0])


def test_shared_keys_answers_in_little_memory(spark):
    """A bucket's keys are copied a few times only, and one holds half a million of them."""
    packed = pa.chunked_array([pa.array([np.arange(k, dtype=np.uint64).tobytes() for k in (3, 1)], pa.binary()),
                               pa.array([np.arange(2, dtype=np.uint64).tobytes()], pa.binary())])
    assert shared._flat(packed, np.uint64).tolist() == [0, 1, 2, 0, 0, 1]
    assert shared._flat(packed.slice(1), np.uint64).tolist() == [0, 0, 1]
    assert not len(shared._flat(pa.chunked_array([], pa.binary()), np.int64))
    assert shared.BUCKET_KEYS <= 1 << 19


def test_gradient():
    truth = np.array([1, 0, 1, 0])
    words = toxicity.read_words(pa.array(["you idiot go away", "nice day", "what a stupid clown", "hello world"]))
    places, _ = toxicity.windows(words)
    w = {k: v.astype(np.float64) for k, v in toxicity.new_weights().items()}
    codes = toxicity._codes(words, places)

    def loss():
        out = toxicity.forward(w, toxicity.gate_inputs(w, toxicity.word_vectors(w, words)), codes)
        return float(np.mean(np.log1p(np.exp(-out * (2 * truth - 1)))))

    vectors = toxicity.word_vectors(w, words)
    g = toxicity.gradient(w, words, vectors, toxicity.gate_inputs(w, vectors), codes, truth)
    for k in w:
        at = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        w[k][at] += 1e-2
        high = loss()
        w[k][at] -= 2e-2
        low = loss()
        w[k][at] += 1e-2
        assert (high - low) / 2e-2 == pytest.approx(g[k][at], rel=0.02, abs=1e-5), k


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 40, 41, 200):
        words = toxicity.read_words(pa.array([" ".join(f"w{k}" for k in range(n)), "x"]))
        places, text = toxicity.windows(words)
        assert set(places[text == 0].ravel()) - {-1} == set(range(n))
        assert (np.unique(text) == [0, 1]).all()


def test_scores_come_from_windows_at_every_word():
    rng = random.Random(5)
    rows = ["", "x", *(" ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(n)) for n in (22, 23, 24, 25, 26, 90, 3, 3000))]
    weights, words = toxicity.new_weights(4), toxicity.read_words(pa.array(rows))
    top = toxicity.top_logits(weights, words, chunk=100)
    for k, row in enumerate(rows):
        part = row.split()
        every = [" ".join(part[i:i + toxicity.WINDOW]) for i in range(max(len(part) - toxicity.WINDOW, 0) + 1)]
        one = toxicity.read_words(pa.array(every))
        assert top[k] == pytest.approx(toxicity.window_logits(weights, one, toxicity.windows(one)[0]).max(), abs=1e-4)


def test_toxicity_learns_from_long_texts(spark):
    rows = [(k, ("plain words here " * 60) + ("vequta " if k % 2 else "") + "and some more of them " * 60) for k in range(120)]
    marks = spark.createDataFrame([(k, 1, k % 2) for k, _ in rows], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(table(spark, rows + rows[:9]), marks, fit_rows=100, fit_chars=1500).collect()
    assert len(got) == 129 and all(r["predicted"] == r["doc_id"] % 2 for r in got)


def test_toxicity_on_held_out_rows(spark):
    """Rude words of one family with endings that the fit has not met, in clean prose."""
    rng = random.Random(2)

    def prose(n):
        return " ".join("".join(rng.choice(["an", "the", "is", "or", "at"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))

    docs, labels = [], []
    for k in range(700):
        bad = k % 4 == 0
        text = prose(rng.randrange(5, 90))
        if bad:
            text += " " + rng.choice(["vequ", "lowei"]) + rng.choice("abcdefgh") + rng.choice(["ta", "mo", "ri"]) + ". " + prose(20)
        docs.append((k, text))
        labels.append((k, 1, int(bad)))
    docs += [(1000, None), (1001, ""), (1002, "!!"), (None, "x y"), (1003, LONG * 5)]
    marks = spark.createDataFrame(labels + [(7777, 1, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(table(spark, docs), marks).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    truth = dict((d, t) for d, _, t in labels)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 90 and np.mean([p == t for p, t in held]) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["predicted"] for r in got if r["doc_id"] in (1000, 1001, 1002)} == {0}
