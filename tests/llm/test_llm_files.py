"""Packing, token files, pages, licenses and the pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from brute import components, exact
from cohorta.llm import licenses, queries
from cohorta.llm.decontaminate import leaks
from cohorta.llm.exact_dedup import exact_dedup
from cohorta.llm.html_text import extract, grow, labelled_table, main_text
from cohorta.llm.jaccard_join import jaccard_components
from cohorta.llm.lm_scores import lm_scores
from cohorta.llm.packing import fullest, pack, plan_bins
from cohorta.llm.repeats import remove_repeats
from cohorta.llm.token_files import NO_KEY, Index, PerfectHash, index_bytes, lookup, read_token_files, round_trip, write_token_files
from cohorta.llm.tokens import default_path, encoded
from cohorta.llm.toxicity import toxicity
from cohorta.session import scratch_path

ODD = ["", " ", "a  b", "a   b", "a\n \nb", " a", "a ", "a \nb", "<|endoftext|> x", "x<|endoftext|>", "a  b", "it's  'll a",
       "naïve \U0001f600 x", "a b\nc\n\nd e", "\n", "a\n", "x 12ab,.;'s ü k", "don't 3.5% 中文 Αβ", None]


def table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, piece string, start int").repartition(4)


def ids_of(text):
    return Tokenizer.from_file(default_path()).encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_encoder_equals_the_tokenizer(documents):
    rows = [t or "" for t in ODD] + [t or "" for _, t in documents]
    want = Tokenizer.from_file(default_path()).encode_batch(rows, add_special_tokens=False)
    got = dict(encoded(pa.array(rows, pa.string()), default_path()))
    assert all(want[k].ids == got[k].tolist() for k in range(len(rows)))


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(k * 3, rng.choice(ODD) if k % 2 else " ".join(rng.choice(["the", "of", "xyz"]) for _ in range(rng.randrange(400))))
            for k in range(60)] + [(None, "no id"), (None, "none"), (9, "again"), (9, "again too")]
    got = round_trip(table(spark, rows), shard_ids=700, part_bytes=2000).collect()
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = ids_of(text)
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_lookup_by_key(spark):
    folder = scratch_path(spark, "lookup")
    rows = [(k * 7, f"text number {k}") for k in range(50)]
    manifest = write_token_files(table(spark, rows), folder, shard_ids=100).orderBy("part", "shard").collect()
    assert len(manifest) > 1 and read_token_files(spark, folder).count() == 50
    for row in manifest:
        found = lookup(folder, row["name"], [k * 7 for k in range(50)] + [3, -1])
        held = [k for k, ids in enumerate(found[:50]) if ids is not None]
        assert len(held) == row["n_rows"] and found[50:] == [None, None]
        assert all(found[k].tolist() == ids_of(rows[k][1]) for k in held)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(-2**62, 2**62, 5000))
    slots = PerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(len(keys)))
    index = Index(index_bytes(np.concatenate(([NO_KEY], keys, keys[-1:]))))
    assert index.rows(keys).tolist() == list(range(1, len(keys) + 1))
    others = np.setdiff1d(np.arange(20000), keys)
    assert (index.rows(others) < 0).mean() > 0.999
    assert Index(index_bytes(np.zeros(0, np.int64))).rows(np.array([1])).tolist() == [-1]


def test_fullest_combination():
    rng = random.Random(4)
    for _ in range(60):
        counts = np.zeros(41, np.int64)
        for _ in range(rng.randrange(1, 9)):
            counts[rng.randrange(1, 41)] += 1
        room, sums = rng.randrange(1, 41), {0}
        for length in np.flatnonzero(counts):
            for _ in range(counts[length]):
                sums |= {s + int(length) for s in sums if s + length <= room}
        chosen = fullest(counts, room)
        assert sum(k * n for k, n in chosen) == max(sums) and all(n <= counts[k] for k, n in chosen)


def test_plan_uses_every_piece_once():
    counts = np.zeros(1025, np.int64)
    counts[np.random.default_rng(1).integers(1, 1025, 300)] += 1000
    used = np.zeros(1025, np.int64)
    for chosen, times in plan_bins(counts, 1024):
        assert sum(k * n for k, n in chosen) <= 1024
        for k, n in chosen:
            used[k] += n * times
    assert (used == counts).all()


def check_packed(rows, got):
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc, text in rows:
        ids, own = ids_of(text), sorted(pieces[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 1024 for r in own[1:]) and len(own) == -(-len(ids) // 1024)
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


def test_packing(spark, documents):
    rows = documents + [(10**6 + k, t) for k, t in enumerate(ODD)] + [(10**7, "word " * 3000 + "end")]
    got = pack(table(spark, rows)).collect()
    bins = check_packed(rows, got)
    assert bins <= sum(r["length"] for r in got) / 1024 * 1.01 + 2


def test_pages(spark):
    page = ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><header><p>Site</p></header>"
            "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class='ad banner'>Buy now</div><article><h1>A &lt;b&gt;</h1>"
            "<p>First <b>bold</b>\n text &amp; more.<br><p>Next&nbsp;one.<!-- <p>no</p> --><div class='comments'><p>I disagree.</p></div>"
            "<form><p>Mail</p></form></article><aside>Side</aside><footer>&copy; us</footer>")
    assert main_text(page, grow(*labelled_table()))[0] == "A <b>\nFirst bold text & more.\nNext one."
    rows = [(1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p></p><"), (3, "w", "<p></p><"), (4, "x", "<article><p>" + "long " * 50000)]
    got = extract(spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == [("1", 39), ("2", 0), ("3", 0), ("3", 0), ("4", 249999), ("None", 0)]
    assert grow(*labelled_table()) == grow(*labelled_table())


@pytest.mark.parametrize("article", ["article", "main", "div"])
@pytest.mark.parametrize("open_, close", [
    ("<body class='has-sidebar no-ads'>", "</body>"), ("<body class='home widget'>", "</body>"), ("<div class='with-menu'>", "</div>"),
    ("<div id='layout-sidebar'>", "</div>"), ("<form id='aspnetForm'>", "</form>"), ("<form>", ""),
    ("<div class='page no-comments'><section class='menu'>", "</section></div>")])
def test_pages_with_wrappers(article, open_, close):
    prose = ["A first long line of the article with quite some words in it.", "And a second one which goes on for as many words or more."]
    page = (f"{open_}<div class='site-menu'><a href='/'>Home</a></div><{article}><p>{prose[0]}</p><p>{prose[1]}</p></{article}>"
            f"<div class='sidebar'>Some words at the side</div><div class='site-footer'>We are us</div>{close}")
    assert main_text(page, grow(*labelled_table()))[0] == "\n".join(prose)
    thread = page + "<div class='comments'>" + "<p>I disagree with all of this and have a lot of words to say about it.</p>" * 9 + "</div>"
    assert "disagree" not in main_text(thread, grow(*labelled_table()))[0]


def test_pages_of_the_table(spark, sf):
    """Pages of the given table mark their article, so its text can be read off."""
    import re
    from html import unescape
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op1_html_extraction(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", rows[r["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<br>|</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p)


def test_licenses(spark):
    mit = dict(licenses.TEMPLATES[::-1])["MIT"]
    rows = [(1, "intro\nReleased under the MIT License.\nmore"), (2, "This work is licensed under the GNU General Public License, version 4."),
            (3, "x\n" + licenses.TEMPLATES[1][1].replace("License at ", "License\nat ")), (4, "no notice, though licensed drivers"), (5, None),
            (6, ""), (7, "This work was licensed under the GNU General Public License, version 3."), (None, mit.upper()), (9, LONG_LICENSE)]
    got = {(r["doc_id"], r["line"]): (r["license"], r["n_different"], r["different"]) for r in licenses.scan(table(spark, rows)).collect()}
    assert got[1, 1] == ("MIT", 0, "") and got[3, 1][:2] == ("Apache-2.0", 0) and got[7, 0] == ("GPL-3.0", 1, "is>was")
    assert got[None, 0][0] == "MIT" and got[9, 30000] == ("CC-BY-NC-4.0", 0, "")
    assert {k[0] for k in got} == {1, 3, 7, 9, None}


def test_licenses_on_long_and_wrapped_lines(spark):
    rng = random.Random(6)

    def prose(n):
        return " ".join(rng.choice(["the", "of", "table", "is", "to", "work", "under", "public", "general"]) for _ in range(n))

    rows, want = [], {}
    for k, (name, text) in enumerate(licenses.TEMPLATES):  # one line of about 30,000 characters
        rows.append((k, prose(3000) + " " + text + " " + prose(3000)))
        want[k] = [(name, 0, 0)]
    rows.append((100, "Released under the MIT License. Then: " + prose(30) + " Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0."))
    want[100] = [("CC-BY-4.0", 0, 0), ("CC-BY-SA-4.0", 0, 0), ("MIT", 0, 0)]
    rows.append((101, "intro\nThis work is\nlicensed under the GNU\nGeneral Public License, version 2.\nmore"))
    rows.append((102, "intro\n# This Source Code Form is subject to the\n# terms of the Mozilla Public License, v. 2.0.\n"))
    rows.append((103, "x\nAll rights\n * reserved."))
    want |= {101: [("GPL-2.0", 1, 0)], 102: [("MPL-2.0", 1, 0)], 103: [("all-rights-reserved", 1, 0)]}
    got = {}
    for r in licenses.scan(table(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["line"], r["n_different"]))
    assert {k: sorted(v) for k, v in got.items()} == want


@pytest.mark.parametrize("text, want", [
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("This work is licensed under the GNU Library General Public License, version 3.", []),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
     ["CC-BY-NC-ND-4.0"]),
    ("// SPDX-License-Identifier: MIT", ["MIT"]), ("SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    ("Licensed under the MIT license", ["MIT"]), ("Licensed under the ISC license", ["ISC"]),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("All rights reserved. All rights reserved.", ["all-rights-reserved"] * 2)])
def test_license_names_bind(text, want):
    assert [r[1] for r in licenses.notices(text.lower(), licenses.known(licenses.TEMPLATES))] == want


def test_licenses_of_the_caller(spark):
    own = [("House-1", "You can use our recipes in your own kitchen as long as you tell your guests whose they are."), ("none", "...")]
    rows = [(1, "x You can use our recipes in your kitchen as long as you tell your guests whose they are"), (2, "MIT License")]
    got = licenses.scan(table(spark, rows), own).collect()
    assert [(r["doc_id"], r["license"], r["different"]) for r in got] == [(1, "House-1", "-own")]
    assert licenses.scan(table(spark, rows), []).count() == 0
    assert licenses.scan(table(spark, [(1, "Released under the MIT License.")] * 2)).count() == 2


def test_licenses_against_a_scan_of_all_places():
    """Every place where the edits of some template are few enough, found by looking at all places, is a notice or
    shares words with a better one; nothing else is a notice."""
    rng, held = random.Random(12), licenses.known(licenses.TEMPLATES)
    filler = sorted({w for t in held.templates for w in t.words} | {f"w{k}" for k in range(60)})
    for _ in range(150):
        words = [rng.choice(filler) for _ in range(60)]
        for t in rng.sample(held.templates, 3):
            copy = list(t.words)
            for _ in range(rng.randrange(t.most + 2)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], [copy[at], rng.choice(filler)], [rng.choice(filler)]])
            words += copy + [rng.choice(filler) for _ in range(rng.randrange(30))]
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        codes, want = np.array([numbers[w] for w in words]), set()
        for t in held.templates:
            edits, begin = licenses.places([numbers.get(w, -1) for w in t.words], codes)
            for end in np.flatnonzero(edits <= t.most).tolist():
                own = licenses.differences(t.words, words[begin[end]:end])
                named = {w for d in own for w in d.replace(">", " ").strip("+-").split()}
                if not (named & held.binding or any(c.isdigit() for w in named for c in w)):
                    want.add((t.name, int(begin[end]), end))
        text, got = " ".join(words), []
        for at, name, _, _, quote in licenses.notices(text, held):
            first = text[:at].count(" ")
            got.append((name, first, first + quote.count(" ") + 1))
        assert set(got) <= want
        assert all(any(a < end and begin < b for _, a, b in got) for _, begin, end in want)


LONG_LICENSE = "line of prose\n" * 30000 + "Licensed under CC BY-NC 4.0."


def test_license_lines_of_the_table(spark, sf, documents):
    lines = {t for _, t in licenses.TEMPLATES}
    want = sorted((d, k) for d, t in documents for k, line in enumerate((t or "").split("\n")) if line in lines)
    assert sorted((r["doc_id"], r["line"]) for r in queries.op2_license_scan(spark, sf).filter("n_different = 0").collect()) == want


def test_empty_tables(spark):
    docs = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (exact_dedup(docs), jaccard_components(docs), remove_repeats(docs), pack(docs), round_trip(docs), lm_scores(docs),
               leaks(docs, bench), toxicity(docs, labels), extract(pages), licenses.scan(docs)):
        assert df.count() == 0
    some = table(spark, [(1, "a b c"), (2, "")])
    assert leaks(some, bench).count() == 0 and toxicity(some, labels).filter("predicted = 0").count() == 2


def test_pipeline(spark, sf, documents):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = dict(documents)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = list(held.items()), stage(spark, docs, sf)
        assert out.columns == docs.columns
        left = {r["doc_id"] for r in out.collect()}
        if name == "toxicity":
            bad = {r["doc_id"] for r in queries.op9_toxicity(spark, sf).filter("predicted = 1").collect()}
            assert left == set(held) - bad
        elif name == "exact dedup":
            assert left == {d for d, v in exact(before).items() if v[2]}
        elif name == "n-gram Jaccard join":
            assert left == {d for d, v in components(before).items() if v[1] == d}
        else:
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert left == {d for d, t in before if not any(i in (t or "") for _, i in items)}
        held = {d: t for d, t in held.items() if d in left}
        docs = docs.filter(docs["doc_id"].isin(list(left)))
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(held)
    check_packed(list(held.items()), got)


def test_stages_with_odd_rows(spark, sf):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x " * 3000, None, "b", 6000),
                                  (2, "x " * 3000, None, "b", 6000), (None, "x", "en", None, 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = sorted((str(r["doc_id"]), (r["text"] or "")[:2]) for r in stage(spark, docs, sf).collect())
        if name == "exact dedup":  # null text equals the empty one, which has an id; the repeated row stays once
            assert left == [("1", ""), ("2", "x "), ("None", "x")]
        else:
            assert left == [("1", ""), ("2", "x "), ("2", "x "), ("None", ""), ("None", "x")]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= 5


def test_words_of_letters_and_a_sign_need_no_pattern(monkeypatch):
    from cohorta.llm import tokens

    class Never:
        def fullmatch(self, word):
            raise AssertionError(word)

    monkeypatch.setattr(tokens, "_PLAIN", Never())
    own = tokens.Encoder(tokens.default_path())
    text = "plain words, only. with (no pattern) needed!"
    ids, offsets = own.encode(pa.array([text.replace("(", "")]))
    assert ids.tolist() == own.tokenizer.encode(text.replace("(", ""), add_special_tokens=False).ids
    assert offsets.tolist() == [0, len(ids)]
