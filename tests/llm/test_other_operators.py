"""Awkward rows and brute force for the remaining operators, each through its own interface."""
import base64
import hashlib
import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import ann, chat, decontaminate, html_text, langid, lattice, warc
from kgspark.llm.common import shared_path
from llm_fixtures import TEXTS, docs

EVENTS = "conv_id long, seq long, kind string, turn long, role string, text string, formatted string"


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = [(1, 0, "message", 0, "user", "hi"), (1, 1, "delta", 1, "assistant", "a"), (1, 2, "delta", 1, "assistant", "b"),
           (1, 3, "message", 2, "user", "more"), (1, 4, "regenerate", 1, "assistant", ""), (1, 5, "delta", 1, "assistant", "c<|x"),
           (1, 6, "message", 2, "user", "again\\"), (1, 7, "edit", 0, "user", "hello"), (2, 0, None, 0, None, None),
           (3, 0, "message", 0, "user", "lost"), (3, 1, "message", 1, "user", "gone"), (3, 2, "regenerate", 0, "user", "")]
    events = spark.createDataFrame([(*e, "x") for e in log], EVENTS)
    rows = {r["conv_id"]: r for r in chat.render(chat.reconstruct(events)).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("segments")).alias("l")).collect()}
    assert [tuple(x) for x in rows[1]["t"]] == [("user", "hello"), ("assistant", "c<|x"), ("user", "again\\")]
    assert rows[1]["l"] == "c<|x"
    assert [tuple(x) for x in rows[2]["t"]] == [("", "")] and [tuple(x) for x in rows[3]["t"]] == [("user", "")]
    assert chat.render(chat.reconstruct(events.limit(0))).collect() == []


@pytest.mark.parametrize("text", ["", "\\", "<|", "\\<|", "<\\|", "|>\\\\|<", "<|end|>", "<", "a\n<|start|>\\", "é<|🙂|>" * 3000])
def test_chat_template_is_reversible(spark, text):
    turns = spark.createDataFrame([(5, 1, "assistant", text), (5, 0, text, text), (5, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    r = chat.render(chat.reconstruct(chat.conversation_events(turns))).select(
        chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("segments")).alias("l")).first()
    assert [tuple(x) for x in r["t"]] == [(text, text), ("assistant", text), ("assistant", text)] and r["l"] == text * 2


def test_warc_round_trip(spark):
    rows = [(3, "http://a/x y", "<p>é"), (1, None, "<p>é"), (2, "u\r\nv", None), (4, "http://b", ""), (None, "n", "<p>é"),
            (1, "dup", "<p>é"), (9, "http://long", "z\r\n\r\n" * 50_000)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, kind string")
    archive = warc.write_archive(pages, shared_path(spark, "w"))
    assert archive.payloads(spark).count() == 3
    for r in warc.read_records(spark, archive).collect():
        head, rest = bytes(r["record"]).split(b"\r\n\r\n", 1)
        size = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")][0].split()[1])
        assert head.startswith(b"WARC/1.1\r\n") and len(rest) == size + 4 and rest.endswith(b"\r\n\r\n")
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]))
                 for r in warc.archive_report(pages).collect())
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert [(g[0], g[1], g[2]) for g in got] == sorted((str(i), len((h or "").encode()), sha(h)) for i, _, h in rows)
    assert Counter((g[3], g[4]) for g in got) == Counter({("response", "None"): 3, ("revisit", "1"): 3, ("revisit", "2"): 1})
    assert warc.archive_report(pages.limit(0)).collect() == []
    assert warc.archive_report(pages, min_bytes=1000).where("record_type = 'revisit'").count() == 0


ITEMS = [(1, " ".join(f"q{i}" for i in range(30))), (2, "short item"), (3, None), (4, "..."), (20, " ".join(f"q{i}" for i in range(10, 40))),
         (5, "a a a a a a a a a a a a a a a"), (6, "item")]


def brute_windows(text):
    ws = decontaminate.words((text or "").encode())
    n = min(13, len(ws))
    return {tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)} if ws else set()


def brute_hits(text):
    ws, hit, found = decontaminate.words((text or "").encode()), set(), set()
    for item, t in ITEMS:
        for w in brute_windows(t):
            for i in range(len(ws) - len(w) + 1):
                if tuple(ws[i:i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(str(item))
    return len(ws), len(hit), sorted(found)


@pytest.mark.parametrize("block", [1_000_000, 25])
def test_decontamination_is_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    q = [f"Q{i}" for i in range(40)]
    texts = TEXTS + [(30, " ".join(q)), (31, "x " + ", ".join(q[3:16]) + " y"), (32, " ".join(q[3:15])), (33, "A Short-Item, no"),
                     (34, "a " * 14 + "b " * 500), (35, "a " * 12), (36, " ".join(q[25:40] + q[:20]))]
    items = spark.createDataFrame([(*x, 0) for x in ITEMS], "item_id long, text string, n_hit int")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"])
                 for r in decontaminate.contamination(docs(spark, texts), items).collect())
    assert got == sorted((str(d), *brute_hits(t)) for d, t in texts)
    assert decontaminate.contamination(docs(spark, []), items).collect() == []
    assert decontaminate.contamination(docs(spark, texts), items.limit(0)).where("n_hit > 0").count() == 0


def brute_clean(text):
    """Spans and the text without them, character by character."""
    word = lambda c: ord(c) >= 128 or c.isdigit() or c.isalpha()
    t, at = text or "", []
    for i, c in enumerate(t):
        if word(c):
            at = [*at[:-1], (at[-1][0], i + 1)] if at and at[-1][1] == i else [*at, (i, i + 1)]
    ws, hit = [t[a:b].encode().lower() for a, b in at], set()
    for _, item in ITEMS:
        for w in brute_windows(item):
            hit |= {p for i in range(len(ws)) if tuple(ws[i:i + len(w)]) == w for p in range(i, i + len(w))}
    starts, ends = sorted(p for p in hit if p - 1 not in hit), sorted(p + 1 for p in hit if p + 1 not in hit)
    gone = {c for a, b in zip(starts, ends) for c in range(at[a][0], at[b - 1][1])}
    return list(zip(starts, ends)), text if text is None else "".join(c for i, c in enumerate(t) if i not in gone)


@pytest.mark.parametrize("block", [1_000_000, 25])
def test_decontaminated_texts_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    q = [f"Q{i}" for i in range(40)]
    texts = [t for t in TEXTS if len(t[1] or "") < 1000] + [
        (30, " ".join(q)), (31, "x " + ", ".join(q[3:16]) + " y"), (32, " ".join(q[3:15])), (33, "Ä Short-Item, no; an ITEM!"),
        (34, "A " * 14 + "b " * 50), (36, "<" + " ".join(q[25:40] + ["é"] + q[:20]) + ">")]
    items = spark.createDataFrame([(*x, 0) for x in ITEMS], "item_id long, text string, n_hit int")
    got = [(str(r["doc_id"]), [(s["start"], s["end"]) for s in r["spans"]], r["text"], r["n_hit"])
           for r in decontaminate.decontaminated(docs(spark, texts), items).collect()]
    want = [(str(d), *brute_clean(t), sum(b - a for a, b in brute_clean(t)[0])) for d, t in texts]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(bool(g[1]) for g in got) == 5
    assert decontaminate.decontaminated(docs(spark, []), items).collect() == []


def test_clean_spans():
    assert decontaminate.clean_spans("Keep THIS, not that one.", [2, 3]) == "Keep THIS,  one."
    assert decontaminate.clean_spans("abc", []) == "abc" and decontaminate.clean_spans("", []) == ""


LANG = [("en", "the cat and the dog were here with them"), ("fr", "le chat et le chien étaient ici avec eux"), ("ru", "кот и собака были здесь")]


def test_language_spans_and_awkward_rows(spark):
    rows = [(i, t, k) for i in range(5) for k, t in LANG] + [(9, "no label", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["en", "fr", "ru"]
    mixed = " ".join([LANG[0][1]] * 3 + [LANG[1][1]] * 2 + [LANG[2][1]])
    texts = TEXTS + [(40, mixed), (41, "123 ... 456 " * 30), (42, "здесь были"), (43, "日本語")]
    got = {r["doc_id"]: r for r in langid.label(docs(spark, texts), model, spans=True).collect()}
    assert len(got) == len({d for d, _ in texts})
    for d in (2, 3, 4, 41):
        assert (got[d]["lang_pred"], got[d]["score"], got[d]["spans"]) == ("und", 0.0, [])
    assert [(s["lang"], s["words"]) for s in got[40]["spans"]] == [("en", 27), ("fr", 18), ("ru", 5)]
    assert got[40]["lang_pred"] == "en" and 0.3 < got[40]["score"] < 0.7 and got[42]["lang_pred"] == "ru"
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[43]["lang_pred"] in model.langs
    empty = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.label(docs(spark), empty).collect()} == {"und"}
    assert langid.label(docs(spark, []), model).collect() == []


def test_viterbi_is_brute_force():
    rng = np.random.default_rng(0)
    counts = np.array([3, 0, 6, 1])
    scores = rng.normal(0, 3, (10, 3)).astype(np.float32)
    labels, at = langid.viterbi(scores, counts, 2.0), 0
    for n in counts:
        s = scores[at:at + n]
        value = lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        paths = [()]
        for _ in range(n):
            paths = [(*p, k) for p in paths for k in range(3)]
        assert value(labels[at:at + n]) == pytest.approx(max(map(value, paths)), abs=1e-4)
        at += n


def test_language_held_out_accuracy(spark):
    from kgspark.llm.queries import op8_language
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    r = op8_language(spark, sf).join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] > 0.98


def test_lattice_sums_all_segmentations():
    pieces = [("▁", 0.0), ("▁a", -1.0), ("a", -2.0), ("b", -3.0), ("ab", -4.0), ("▁ab", -5.0), ("ba", -6.0)]
    names, logp = [p for p, _ in pieces], lattice.start_weights(pieces)
    weight = dict(zip(names, logp))

    def paths(t):
        if not t:
            return [[]]
        out = [[p, *rest] for p in names if t.startswith(p) for rest in paths(t[len(p):])]
        if t[0] not in weight:
            out += [[t[0], *rest] for rest in paths(t[1:])]
        return out

    words = ["", "a", "abab", "aé🙂b", "bbba"]
    lw = lambda p: weight.get(p, len(p.encode()) * lattice.BYTE)
    z, expected = lattice.lattice(words, lattice.Pieces(names), logp, np.ones(len(words)))
    want, counts = [], Counter()
    for w in words:
        ps = [(math.exp(sum(map(lw, p))), p) for p in paths("▁" + w)]
        total = sum(x for x, _ in ps)
        want.append(math.log(total))
        for x, p in ps:
            for piece in p:
                counts[piece] += x / total
    assert z == pytest.approx(want) and expected == pytest.approx([counts[n] for n in names])


def test_lattice_scores_awkward_rows(spark):
    pieces = [("▁", 0.0), ("a", -1.0), ("▁w", -2.0), ("ord", -3.0)]
    rows = docs(spark).withColumn("learn", F.coalesce(F.col("doc_id") != 9, F.lit(True)))
    got = lattice.score(rows, pieces).collect()
    assert len(got) == len(TEXTS) and all(r["score"] < 0 and math.isfinite(r["score"]) and r["n_known"] <= r["n_tokens"] for r in got)
    words = lambda t: (t or "").encode().translate(lattice.LOWER).split()
    c = Counter(w for d, t in TEXTS if d != 9 for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None]), 6)) for d, t in TEXTS)
    assert sorted((str(r["doc_id"]), round(r["base_score"], 6)) for r in got) == want
    assert lattice.score(rows.limit(0), pieces).collect() == []


def test_ann_recall_ties_and_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, (3000, 1))
    x[100:400] = x[7]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [None] * 24), (None, [1.0] * 24), (5, rows[5][1])]
    vectors = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = ann.search(vectors, k=10, is_query=F.col("vec_id") % 60 == 0).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 3000, 60))
    hits = 0
    for q, found in by.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(3000), -np.round(s, 9))) if i != q][:10]
        hits += len({i for i, _ in found} & set(order))
        assert len(found) == 10 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(sc - s[i]) < 1e-9 for i, sc in found)
    assert hits / (10 * len(by)) >= 0.9
    same = [7, *range(100, 400)]  # equal vectors come by id, the query itself left out
    for q in (120, 240, 60):
        copies = [i for i, _ in by[q] if i in same]
        assert copies == [i for i in same if i != q][:len(copies)]
    assert ann.search(vectors.limit(0), k=3).collect() == []


def test_ann_unequal_norms_and_small_tables(spark):
    rng = np.random.default_rng(6)
    flat = rng.normal(size=(2000, 24))
    flat /= np.linalg.norm(flat, axis=1)[:, None]
    long = flat.copy()
    long[11] *= 20
    spread = flat * rng.lognormal(size=(2000, 1))
    for x, k, step in ((long, 20, 50), (spread, 20, 50), (flat[:10], 20, 1)):
        rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
        got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=k, is_query=F.col("vec_id") % step == 0)
        by, hits = {}, 0
        for r in got.collect():
            by.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert set(by) == set(range(0, len(x), step))
        for q, found in by.items():
            true = [i for i in np.argsort(-(x @ x[q]), kind="stable") if i != q][:k]
            assert len(found) == len(true)
            hits += len(found & set(true)) / len(true)
        assert hits / len(by) >= (0.9 if len(x) > 10 else 1)


def test_ann_exact_search_of_queries_left_short(spark):
    """One table and one probe leave queries short; an id with many near vectors counts once."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(9000, [float(a) for a in x[0] * (1 + j / 1000)]) for j in range(1, 30)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=40,
                     is_query=F.col("vec_id") % 100 == 0, tables=1, probes=1)
    by = {}
    for r in got.where("query_id < 9000").orderBy("rank").collect():
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    y = np.array([v for _, v in rows])
    for q in range(0, 600, 100):
        best = {}
        for (i, _), s in zip(rows, y @ x[q]):
            best[i] = max(s, best.get(i, -9))
        assert by[q] == sorted((i for i in best if i != q), key=lambda i: (-best[i], i))[:40]


def test_ann_classes_hold_bounded_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "ID_SLICE", 20)
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i + 1), 1.0]) for i in range(3000)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    classes, queries = ann._classes(vectors, "vec_id", "embedding", 2, F.col("vec_id") % 2 == 0)
    got = classes.collect()
    assert max(len(x) for r in got for x in r if isinstance(x, list)) == 3  # vectors and the k + 1 ids, no list of queries
    assert len(got) == 1001 and [r["ids"] for r in got if list(r["v"]) == [1.0, 2.0]] == [[1, 2, 4]]
    shared = next(r["class"] for r in got if list(r["v"]) == [1.0, 2.0])
    assert sorted(r["query_id"] for r in queries.where(F.col("query") == shared).collect()) == [i for i in range(0, 3000, 2) if i % 3]
    assert queries.count() == 1500


PAGE = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><!-- c --><header>H</header><nav><ul><li>m</ul></nav>"
        "<div class='ad box'>buy</div><article class=post><h1>A &amp; B</h1><p>one<br>two<p><b>three &eacute; <a href=\"x>y\">link</a>"
        "<div id=comments>nice</div><form><input>f</form><aside>s</aside><ul><li>i1<li>i2</ul></article><footer>f</footer>")


def test_html_structure():
    assert [t for p, t in html_text.read_blocks(PAGE) if p == "main"] == ["A & B", "one two", "three é link", "i1", "i2"]
    assert html_text.read_blocks("") == [] and html_text.read_blocks("<<>< &lt;b") == [("open", "<<>< <b")]


@pytest.mark.parametrize("page, want", [
    ("<body><div class='page has-sidebar'><article><p>text</article><div class=sidebar>s</div></div>", ["text"]),
    ("<div id=content class=nav-open><main>text</main></div>", ["text"]),
    ("<div class='page sidebar'>menu<article>text</article></div>", ["text"]),
    ("<div class=widget><article>teaser</article></div><article>text</article>", ["text"]),
    ("<body><form action=x><div class=menu>m</div><article>text</article><label>l</label></form>", ["text"]),
    ("<body><p>top</p><form runat=server><nav>n</nav><div><p>text and more</p></div><input></form>", ["top", "text and more"]),
    ("<p>text and more</p><form>search</form>", ["text and more"]),
    ("<div class=widget><p>text</p></div>", ["text"]),
    ("<article><section class=related-work>a</section><p class=alert role=alert>b</p><div class='comment-list'>c"
     "<article>d</article></div><div class=site-footer>e</div>f</article>", ["a", "b", "f"]),
])
def test_html_weak_evidence_keeps_the_content(page, want):
    found = html_text.read_blocks(page)
    main = [t for p, t in found if p == "main"]
    assert (main or [t for p, t in found if p == "open"]) == want


def test_html_boilerplate_without_an_article(spark, monkeypatch):
    said = "all rights reserved by the owner of this site"
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(i, "http://h.example/x", f"<div>Home</div><div>{body(i)}</div><div>{said}</div>") for i in range(6)]
    rows += [(50, "http://other/", f"<p>{said}</p>"), (51, None, None), (52, "http://h.example/", ""), (53, "bad url", PAGE), (53, "bad url", PAGE)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    for shard in (500_000, 60):
        monkeypatch.setattr(html_text, "SHARD", shard)
        got = sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect())
        want = [(i, body(i)) for i in range(6)] + [(50, said), (51, ""), (52, "")] + [(53, "A & B\n\none two\n\nthree é link\n\ni1\n\ni2")] * 2
        assert got == [(i, t, len(t)) for i, t in want]
    assert html_text.extract(pages.limit(0)).collect() == []


def test_html_copies_and_rare_repeats_are_no_boilerplate(spark, monkeypatch):
    said = "all rights reserved by the owner of this site"
    quote = "a long passage that two pages of a big host quote from each other word by word"
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows, want = [], {}
    for i in range(40):  # copies of one page, on a host of nothing else
        rows.append((i, "http://copies/", f"<div>Title</div><div>{body(0)}</div><nav>ad {i}</nav>"))
        want[i] = f"Title\n\n{body(0)}"
    for i in range(100, 130):  # a heading on every page, a passage on two; three pages twice
        page = f"<div>Home</div><div>{body(i)}</div><div>Summary</div>" + f"<div>{quote}</div>" * (i < 102) + f"<div>x{body(i)}</div><div>{said}</div>"
        for copy in (0, 1000)[:1 + (i < 103)]:
            rows.append((i + copy, "http://big/", page))
            want[i + copy] = "\n\n".join([body(i), "Summary", *[quote] * (i < 102), "x" + body(i)])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (500_000, 400):
        monkeypatch.setattr(html_text, "SHARD", shard)
        assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == want


def test_html_array_judges_blocks_of_articles(spark, monkeypatch):
    notice = "please read our new terms of use before you go on"
    quote = "a passage of nine words that several articles quote"
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows, want = [], {}
    for i in range(8):  # a notice in four articles that four other pages have in their footer; the lead of page 0 as a teaser on all
        inside = f"<p>{notice}</p>" * (i < 4) + f"<p>{quote}</p>" * (i > 2) + "<p>Read on</p>"
        rows.append((i, "http://h/", f"<article><h1>{body(i)}</h1>{inside}<p>end{body(i)}</p></article>"
                                     f"<aside>{body(0)}</aside><footer>{notice if i > 3 else 'f'}</footer>"))
        want[i] = "\n\n".join([body(i), *[quote] * (i > 2), "Read on", "end" + body(i)])
    for i in range(100, 104):  # near copies, whose first paragraph is a teaser on other pages
        rows.append((i, "http://near/", f"<article><p>{body(1)}</p><p>{body(2)}</p><p>only {i}</p></article>"))
        rows.append((i + 50, "http://near/", f"<nav>{body(1)}</nav><article>{body(i)}</article>"))
        want |= {i: f"{body(1)}\n\n{body(2)}\n\nonly {i}", i + 50: body(i)}
    rows.append((9, *rows[0][1:]))  # a copy
    want[9] = want[0]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (500_000, 150):
        monkeypatch.setattr(html_text, "SHARD", shard)
        assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == want


def test_run_ranks_compare_first_words():
    tokens = np.random.default_rng(2).integers(1, 4, 300).astype(np.uint64)
    rank = html_text.run_ranks(tokens)
    head = [tuple(tokens[i:i + html_text.RUN]) for i in range(300)]
    for i, j in combinations(range(300), 2):
        assert (head[i] == head[j]) == (rank[i] == rank[j]) and (head[i] < head[j]) == (rank[i] < rank[j])


COMMENTED = """<main><header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>body</p><section id=user-comments><p>c1</p></section>
<ol class=commentlist><li>c2</ol><div class="ad-slot">buy</div><article class="comment"><p>c3</p></article><p class="comments-open">kept</p></article></main>"""


def test_html_leaves_out_what_readers_and_advertisers_wrote():
    assert [t for p, t in html_text.read_blocks(COMMENTED) if p == "main"] == ["Head", "body", "kept"]


@pytest.mark.parametrize("page,want", [
    ("<article><p data-x=don't>hello</p><p>it's fine</p></article>", ["hello", "it's fine"]),
    ("<article><p title=\"a > b\" id='x>y'>one</p><p a = 'unclosed>two</p></article>", ["one", "two"]),
    ("<article><p a=b/>x</p><a href=/p/>y</a><br/>z</article>", ["x", "y z"]),
    ("<article>1 < 2 <3 <!-- > --> <? php > 4 <p>5</article>", ["1 < 2 <3 4", "5"]),
    ("<article><script>if (a < b) '</p>'</SCRIPT >after<style>x", ["after"])])
def test_html_odd_tags(page, want):
    assert [t for p, t in html_text.read_blocks(page) if p == "main"] == want


@pytest.mark.parametrize("unit", ['<a "x ', "<div>", "<p><b>", "<li><b>", "<a href='", "<!--", "<!", "</b>", "<script", "<b a=\"x>", "<div></p>", "<td><dt>", "<"])
def test_html_reader_is_linear(unit):
    import time
    times = []
    for size in (100_000, 1_600_000):
        page = unit * (size // len(unit))
        start = time.process_time()
        html_text.read_blocks(page)
        times.append(time.process_time() - start)
    assert times[1] < 40 * times[0] + 0.5  # sixteen times the length; a square would be 256
