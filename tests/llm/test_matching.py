"""Near-duplicates, decontamination and extraction against brute force, and on odd input."""
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starforge.llm import op1_minhash_dedup as dedup
from starforge.llm import op4_embedding_dedup as vectors
from starforge.llm import op9_decontamination as leaks
from starforge.llm.components import components
from starforge.llm.op10_html_extraction import extract_main_text, main_text

from .conftest import sentence


def union_find(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    for n, m in ((30, 20), (200, 180), (60, 400)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(500, 540)]
        links = [(a, b) for a, b in links if a != b]
        want = union_find({x for pair in links for x in pair}, links)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
        assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("n", [1, 4, 40, 3000])
def test_signatures_estimate_weighted_jaccard(n):
    rng = np.random.default_rng(n)
    element = rng.integers(0, 2 ** 63, n).astype(np.uint64)
    a = rng.integers(0, 4, n) * 0.7 + rng.random(n) + 0.05
    b = np.where(rng.random(n) < 0.4, a * 0.5, a)
    k = 1500
    s = dedup.dart_signatures(np.repeat([0, 1], n), np.tile(element, 2), np.concatenate([a, b]), 2, k)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 4.5 * (max(true * (1 - true), 0.01) / k) ** 0.5


def shared_words(a, b):
    """Share of the words of ``a`` in a five-word run that ``b`` has too; texts of under five words are one run."""
    runs = {tuple(b[j:j + 5]) for j in range(max(len(b) - 4, 1))}
    if len(a) < 5:
        return float(tuple(a) in runs)
    covered = set()
    for j in range(len(a) - 4):
        if tuple(a[j:j + 5]) in runs:
            covered.update(range(j, j + 5))
    return len(covered) / len(a)


def alike(a, b, threshold=0.8):
    a, b = (dedup.WORD.findall((t or "").lower()) for t in (a, b))
    return bool(a and b) and min(shared_words(a, b), shared_words(b, a)) >= threshold


def brute_classes(rows, threshold=0.8):
    rows = [(i, t) for i, t in rows if i is not None]
    links = [(a, b) for k, (a, x) in enumerate(rows) for b, y in rows[:k] if a != b and (x == y and x or alike(x, y, threshold))]
    links = [(a, b) for a, b in links if any(dedup.WORD.search(t or "") for i, t in rows if i == a)]
    return union_find({a for a, _ in rows}, links)


def test_similarity_as_counted_by_words():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        b = list(a) if rng.random() < 0.8 else [rng.choice("abc") for _ in range(rng.randint(1, 30))]
        for _ in range(rng.randint(0, 3)):
            b[rng.randrange(len(b))] = rng.choice("xyz")
        x, y = (dedup.shingles(" ".join(t), dedup.WordHashes()) for t in (a, b))
        assert dedup.similarity(x, y) == pytest.approx(min(shared_words(a, b), shared_words(b, a)))


def test_shared_parts_of_many_texts_at_once():
    rng = random.Random(3)
    cache = dedup.WordHashes()
    for _ in range(100):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 12))]
        known = [dedup.shingles(t, cache) for t in texts]
        for other in (rng.choice(known), dedup.shingles(" ".join(rng.choice("abcx") for _ in range(30)), cache)):
            assert dedup.SharedParts(known).within(other).tolist() == [dedup.shared_part(t, other) for t in known]


def test_block_links_of_nodes_with_any_number_of_earlier_bands():
    """Pairs that an earlier band holds are left to it; rows carry the earlier mixed bands alone."""
    words = sentence(random.Random(8), "en", 60)
    rows = pd.DataFrame([(9, 0, 1, 1, False, [2, 5], words), (9, 0, 2, 2, False, [], words), (9, 0, 3, 3, False, [7], words + " one more"),
                         (9, 0, 4, 4, False, [], sentence(random.Random(9), "fr", 60)), (9, 0, 8, 8, True, [5, 7], words)],
                        columns=["band", "block", "node", "label", "seeker", "bands", "text"])
    assert dedup.block_links(rows, 0.8).to_numpy().tolist() == [[8, 2]]
    rows.at[4, "bands"] = []
    assert dedup.block_links(rows, 0.8).to_numpy().tolist() == [[8, 1], [8, 2], [8, 3]]


def test_texts_that_share_a_passage_are_compared_whole(spark, monkeypatch):
    """Bands of many components: pairs that no leader joins are still linked, in whatever band they meet first."""
    rng = random.Random(10)
    passage, rows = sentence(rng, "en", 60).split(), []
    for i in range(24):
        own = sentence(rng, "fr", 25).split()
        near = [f"n{i}" if j == 3 * (i % 8) else w for j, w in enumerate(own)]
        rows += [(2 * i, " ".join(passage + own)), (2 * i + 1, " ".join(passage + near))]
    monkeypatch.setattr(dedup, "LEADERS", 1)
    monkeypatch.setattr(dedup, "BLOCK", 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in dedup.near_duplicate_classes(docs, threshold=0.9).collect()}
    assert got == brute_classes(rows, 0.9) and len(set(got.values())) == 24


def test_recall_of_copies_with_changed_words(spark):
    """Copies with 2, 5 and 8 % of their words changed are found, texts that share a third of their words are not."""
    rng = random.Random(4)
    rows, pairs = [], []
    for i in range(150):
        words = sentence(rng, "en", rng.randint(60, 400)).split()
        copy = [f"new{rng.randrange(10 ** 6)}" if rng.random() < (0.02, 0.05, 0.08)[i % 3] else w for w in words]
        third = words[:len(words) // 3] + sentence(rng, "de", len(words)).split()
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(copy)), (3 * i + 2, " ".join(third))]
        pairs.append((3 * i, 3 * i + 1))
    got = {r["doc_id"]: r["class_id"] for r in dedup.near_duplicate_classes(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    texts = dict(rows)
    near = [(a, b) for a, b in pairs if alike(texts[a], texts[b])]
    assert len(near) > 130 and sum(got[a] == got[b] for a, b in near) / len(near) >= 0.98
    assert all(got[3 * i + 2] == 3 * i + 2 for i in range(150))


def test_hot_texts_bands_and_leaders_are_dealt_out(spark, monkeypatch):
    """With a low limit for hot keys the classes are the same, whatever rows share a text, a band or a leader."""
    rng = random.Random(6)
    base = sentence(rng, "en", 80).split()
    rows = [(i, " ".join(base)) for i in range(30)] + [(i, None if i % 2 else "?!") for i in range(30, 60)]
    for i in range(60, 90):
        copy = list(base)
        copy[i - 55] = f"w{i}"
        rows.append((i, " ".join(copy)))
    rows += [(90 + i, sentence(rng, "fr", 40)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(dedup, "HOT", 3)
    got = {r["doc_id"]: r["class_id"] for r in dedup.near_duplicate_classes(docs).collect()}
    assert got == brute_classes(rows)


@pytest.mark.parametrize("counts", [False, True])
def test_classes_equal_brute_force(corpus, odd_documents, counts):
    for docs in (corpus[0].select("doc_id", "text"), odd_documents):
        rows = dedup.near_duplicate_classes(docs, counts=counts).collect()
        assert len(rows) == docs.count()
        want = brute_classes([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
        for r in rows:
            if r["doc_id"] is None:
                assert r["class_id"] is None and r["kept"]
            else:
                assert r["class_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["class_id"])


def test_bands_with_several_components_are_compared_whole(spark, monkeypatch):
    """Copies that are near their original only: the smallest id is not the one they link to."""
    monkeypatch.setattr(dedup, "BLOCK", 4)
    rng = random.Random(9)
    words = sentence(rng, "en", 200).split()
    rows = []
    for i in range(24):
        copy = list(words)
        for j in range(7 * i, 7 * i + 24):      # near the original, most not near each other
            copy[j] = f"changed{i}x{j}"
        rows.append((i, " ".join(copy)))
    rows.append((99, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in dedup.near_duplicate_classes(docs).collect()}
    assert got == want


def test_ids_with_several_texts_are_one_document(spark):
    """An id with two texts in a band of several components, and ids linked by one of their texts only."""
    rng = random.Random(9)
    words, other = sentence(rng, "en", 200).split(), sentence(rng, "de", 60).split()
    rows = []
    for i in range(12):
        copy = list(words)
        for j in range(14 * i, 14 * i + 24):
            copy[j] = f"changed{i}x{j}"
        rows.append((i, " ".join(copy)))
    rows += [(5, " ".join(other)), (0, sentence(rng, "fr", 60)), (0, "")]
    rows += [(50, " ".join(other)), (40, " ".join(["new", *other])), (40, sentence(rng, "fr", 50)), (40, None)]
    docs = spark.createDataFrame(rows + rows[:3] * 3, "doc_id long, text string")
    want = brute_classes(rows)
    got = dedup.near_duplicate_classes(docs).collect()
    assert len(got) == docs.count()
    assert {(r["doc_id"], r["class_id"], r["kept"]) for r in got} == {(i, c, i == c) for i, c in want.items()}


def test_one_of_each(odd_documents, no_documents):
    kept = dedup.one_of_each(odd_documents, dedup.near_duplicate_classes(odd_documents))
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11] and ids.count(None) == 2
    assert dedup.near_duplicate_classes(no_documents).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 16))
    base[50:120] = base[0] + rng.normal(size=(70, 16)) * 0.08        # a dense group
    base[200:230] = base[1]                                           # copies
    base[230:240] = base[2] * np.linspace(0.5, 3, 10)[:, None]       # scaled copies
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [None] * 16), (304, [float("inf")] * 16),
             (305, []), (306, [1.0, 2.0]), (307, [2.0, 4.0]), (308, [1e200] * 16), (309, [1e-200] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>") \
        .withColumn("node", F.lit(1)).withColumn("raw", F.lit(2)).withColumn("label", F.lit(None))
    ok = {i: np.array(v) / np.abs(v).max() for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    want = union_find([i for i, _ in rows], links)
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    got = {r["vec_id"]: r for r in vectors.near_duplicate_vectors(frame).collect()}
    assert len(got) == len(rows) == vectors.near_duplicate_vectors(frame).count()
    found = sum(r["n_links"] for r in got.values())
    assert 0.99 * sum(n.values()) <= found <= sum(n.values())
    assert all(r["n_links"] <= n[i] for i, r in got.items())
    assert sum(r["component_id"] == want[i] for i, r in got.items()) >= 0.99 * len(rows)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert all(got[i]["n_links"] == 0 for i in (300, 301, 302, 303, 304, 305)) and got[308]["component_id"] == 308


def test_vector_blocks_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    rng = np.random.default_rng(8)
    base = rng.normal(size=8) + rng.normal(size=(60, 8)) * 0.02
    rows = [(i % 58, v.tolist()) for i, v in enumerate(base)] + [(None, base[0].tolist())]
    got = vectors.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 61 and all(r["n_links"] == 60 for r in got)
    assert {r["component_id"] for r in got if r["vec_id"] is not None} == {0}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.near_duplicate_vectors(empty).count() == 0
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vectors.near_duplicate_vectors(nulls).collect()] == [(1, 0, 1, True)]


def edits_within(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edited_passages_equal_brute_force():
    rng = random.Random(6)
    items = [(i, sentence(rng, "en", rng.randint(3, 40))) for i in range(12)]
    index = leaks.Index.of(items)
    for trial in range(80):
        s = rng.randrange(len(index.points))
        pattern = "".join(map(chr, index.points[s]))
        text = list(pattern)
        for _ in range(rng.randint(0, int(index.edits[s]) + 2)):
            at = rng.randrange(len(text))
            if rng.random() < 0.4:
                text[at] = rng.choice("qxz")
            elif rng.random() < 0.5:
                text.insert(at, rng.choice("qxz"))
            elif len(text) > 1:
                del text[at]
        host = sentence(rng, "en", 40)
        text = leaks.normalized(host[:60] + " " + "".join(text) + " " + host[60:])
        want = edits_within(pattern, text)
        got = [m for _, m in leaks.text_matches(index, [text]) if (m[0], m[1]) == (index.item[s], index.number[s])]
        assert bool(got) == (want <= index.edits[s])
        if got:
            assert got[0][4] == want
            found = text[got[0][2]:got[0][2] + got[0][3]]
            assert edits_within(pattern, found) == want


def test_passages_from_every_place_of_an_item_are_found():
    rng = random.Random(12)
    items = [(i, leaks.normalized(sentence(rng, "en", 90))[:n]) for i, n in enumerate((81, 100, 128, 130, 233, 256, 300))]
    index = leaks.Index.of(items)
    host = leaks.normalized(sentence(rng, "de", 40))
    shortest = leaks.WINDOW + leaks.STRIDE - 1
    for item, text in items:
        for length in (shortest, 110, 150, 200, 250):
            rows = [host[:100] + " " + text[at:at + length] + " " + host[100:] for at in range(len(text) - length + 1)]
            found = {i for i, m in leaks.text_matches(index, rows) if m[0] == item}
            assert found == set(range(len(rows))), (item, length)
    text, rows = items[4][1], []
    for at in range(0, len(text) - shortest + 1, 7):      # with five edits
        passage = list(text[at:at + shortest])
        for k in rng.sample(range(len(passage)), 5):
            passage[k] = "q" if k % 2 else passage[k] + "x"
        rows.append(host[:100] + " " + "".join(passage) + " " + host[100:])
    assert {i for i, m in leaks.text_matches(index, rows) if m[0] == 4} == set(range(len(rows)))


def test_contaminated_documents(spark, corpus, monkeypatch):
    monkeypatch.setattr(leaks, "SLICE", 300)
    docs, _ = corpus
    rng = random.Random(2)
    items = [(i, sentence(rng, "en", 40)) for i in range(8)] + [(8, None), (9, ""), (10, "ab"), (11, "tiny one")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    planted = {5: items[0][1].upper(), 9: items[1][1].replace(" ", " - "), 12: items[2][1][:150], 17: items[3][1] * 2}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = [(i, texts[i][:400] + "\n" + planted[i] + " " + texts[i][400:] if i in planted else t)
            for i, t in texts.items()] + [(1000, "AB!"), (1001, None), (1002, ""), (None, items[4][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    for block in (leaks.BLOCK_CHARS, 300):
        found = leaks.matches(frame, bench, block_chars=block).select("doc_id", "item_id").distinct().collect()
        assert {tuple(r) for r in found} == {(5, 0), (9, 1), (12, 2), (17, 3), (1000, 10), (None, 4)}
        clean = frame
        for c in leaks.clean_conditions(bench, F.col("text"), block_chars=block):
            clean = clean.where(c)
        assert clean.count() == len(rows) - 6
    rows = {(r["doc_id"], r["item_id"]): r for r in leaks.contaminated(frame, bench).collect()}
    assert rows[5, 0]["edits"] == 0 and rows[17, 3]["n_segments"] >= 2


def test_decontamination_odd_input(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "some benchmark item text that is long")], "item_id long, text string")
    assert leaks.contaminated(odd_documents, bench).count() == 0
    assert leaks.contaminated(no_documents, bench).count() == 0
    assert leaks.contaminated(odd_documents, bench.limit(0)).count() == 0


PAGES = [
    ("<html><head><title>x</title></head><body class='home'><div id='cookie-notice'>We use cookies</div><header><a href=/>"
     "Home</a> Site</header><div class='layout'><div class='sidebar'><p>Side text that is long enough to be dense prose."
     "</p></div><div class='post-content'><h1>Title &amp; more</h1><p>First para with&nbsp;some   text and <a href=x>a "
     "link</a>.</p><p>Second<br>para here, long long text.</p><table><tr><td>a<td>b</table><ul><li>One<li>Two</ul></div>"
     "</div><form><input><label>Name</label></form><div class='comments'><p>A reader comment that is longer than the "
     "article itself, perhaps, and wordy.</p><article class='comment'>me too</article></div><footer>c</footer></body></html>",
     "Title & more\nFirst para with some text and a link.\nSecond para here, long long text.\na\nb\nOne\nTwo"),
    ("<nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav><div class=ad>Buy now</div><article><h1>T</h1><p><b>T"
     "<br><p>Short.</p></article><footer>&copy; x</footer>", "T\nT\nShort."),
    ("<body><nav>m</nav><h1>T</h1><p>one</p><p>two</p><div class=footer>f</div></body>", "T\none\ntwo"),
    ("<script>var a='<p>no</p>';</script><p>yes &lt;b&gt; &#233;</p><style>p{}</style>", "yes <b> é"),
    ("<p>a<p>b", "a\nb"),
    ("plain &lt; text", "plain < text"),
    ("<div hidden>no</div><div style='display: none'>no</div><p>x <i>y</i>z</p>", "x yz"),
    ("<article><header class='article-header'><h1>Head</h1></header><p>Body text.</p><aside>Side</aside></article>",
     "Head\nBody text."),
    ("<form id=page><article><p>kept although a form surrounds it</p></article></form>", "kept although a form surrounds it"),
    ("<div class=comments><article class=comment><p>no</p></article></div><main><p>yes</p></main>", "yes"),
    ("<header><h1>Site</h1></header><div class='overflow-hidden'><h1>Story</h1><p>Text of it.</p></div>"
     "<aside><article><p>Other story</p></article></aside>", "Story\nText of it."),
    ("<div id=top class=header><h1>Site</h1><p>Slogan</p></div><div id=content><h1>T</h1><div class=notice>Sale!</div>"
     "<p>Only text.</p><p class=advert>Buy</p><p>More text.</p></div>", "T\nOnly text.\nMore text."),
    ("<div class='page header-fixed'><h1>Held</h1><p>by its heading</p></div>", "Held\nby its heading"),
    ("<article><p>a</p><p>b</p></article><section class=reader-comments><article><p>A long reader comment, longer than all "
     "of the article.</p></article></section>", "a\nb"),
    ("<script>never closed <p>x", ""), ("", ""), (None, ""), ("<div></div>", ""),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    assert main_text(html) == text


def test_extract_pages(spark):
    rows = [(i, f"http://x/{i}" if i else None, h) for i, (h, _) in enumerate(PAGES)] + [(None, None, "<p>é</p>")] * 2
    rows.append((99, "u", "<div>" * 3000 + "deep" + "<p>w</p>" * 5000))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string") \
        .withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = extract_main_text(pages).collect()
    assert len(got) == len(rows)
    want = {i: t for i, (_, t) in enumerate(PAGES)}
    for r in got:
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] in want:
            assert r["text"] == want[r["page_id"]] and r["url"] == (f"http://x/{r['page_id']}" if r["page_id"] else None)
    assert extract_main_text(pages.limit(0)).count() == 0
