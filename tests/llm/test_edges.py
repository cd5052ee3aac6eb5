"""Clashing columns, odd ids, long texts and small parties, held against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_llm_operators import repeats

from strandline.llm import base, decontaminate, embedding_join, language_id, mixing, ngram_join, quotations, suffix_dedup, textscan, token_counts, warc, wrappers

rng = random.Random(23)
LETTERS = {"aa": "abcdefg", "bb": "efghijkl", "cc": "ijklmnop"}


def words_of(lang, n):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(1, 6))) for _ in range(n))


def test_shared_folder_is_asked_for(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda s: type("O", (), {"isEmpty": lambda o: True})()})()})()

        def getConf(self):  # noqa: N802
            return {}

    session = type("Session", (), {"sparkContext": Context(), "conf": type("C", (), {"get": lambda self, key, default: default})()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        base.shared_dir(session)


def test_words_of_long_texts(monkeypatch):
    """Hashes don't depend on the stretches that a text is read in."""
    data = np.frombuffer(" ".join(words_of("aa", 4) + "x" * rng.randint(0, 90) for _ in range(200)).encode(), np.uint8)
    offsets = np.array([0, 1000, 1000, len(data)])
    whole = textscan.Words(data, offsets, textscan.NOT_SPACE)
    monkeypatch.setattr(textscan, "STRETCH", 50)
    parts = textscan.Words(data, offsets, textscan.NOT_SPACE)
    assert (whole.hash == parts.hash).all() and (whole.start == parts.start).all() and (whole.first == parts.first).all()


@pytest.mark.parametrize("sources", [60, 7])
def test_small_sources_get_their_part(spark, sources):
    rows = [(k, f"s{k % sources:02d}", " ".join(["w"] * (5 if sources == 60 else 1 + k % 40))) for k in range(sources * (1 if sources == 60 else 30))]
    rows += [(None, "s00", "one two three"), (None, "s00", "one two four"), (None, "s00", None)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string"), "doc_id", "source", "text", shard=100).collect()
    taken, target, size = collections.Counter(), {}, {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert abs(sum(taken.values()) - sum(size.values())) <= 1


def test_warc_odd_ids(spark, tmp_path):
    """Ids with line ends, marks and the word None come back as they are."""
    pages = [("a\r\nb: c", "u", "x"), ("None", None, "y"), (None, "u", "z"), ("<é %0D>", "u", "x"), ("", None, "w")]
    folder = f"file://{tmp_path}/odd"
    assert warc.write_archives(spark.createDataFrame(pages, "page_id string, url string, html string"), folder) == len(pages)
    got = {(r["record_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, folder).collect()}
    assert got == {("a\r\nb: c", "revisit", "<é %0D>"), ("<é %0D>", "response", None), ("None", "response", None), (None, "response", None), ("", "response", None)}


def test_warc_reads_what_the_manifest_lists(spark, tmp_path):
    folder = f"file://{tmp_path}/left"
    warc.write_archives(spark.createDataFrame([(k, f"p{k}") for k in range(9)], "page_id long, html string"), folder, url_col=None)
    stray = warc.Writer([])
    stray.add(warc.record("response", {"WARC-Record-ID": "<urn:page:77>", "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": "sha1:" + warc.base32_sha1(b"q")}, b"q"))
    (tmp_path / "left" / "part-000000-lost-0000.warc.zst").write_bytes(stray.bytes())
    assert sorted(int(r["record_id"]) for r in warc.read_archives(spark, folder).collect()) == list(range(9))


def rank_order(texts, listed):
    """Profile of some texts, plainly."""
    seen = collections.Counter()
    for t in texts:
        code = f" {' '.join(re.findall(r'[a-z]+', t.lower()))} "
        for n in (1, 2, 3):
            seen.update(g for k in range(len(code) - n + 1) if (g := code[k : k + n]) != " " and not (n == 3 and g[1] == " "))
    key = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return sorted(seen, key=lambda g: (-seen[g], key(g)))[:listed]


def test_language_profiles_brute_force(spark):
    labelled = [(k, words_of(lang, rng.randint(1, 60)), lang) for k, lang in enumerate(list(LETTERS) * 12)]
    asked = [(100 + k, words_of(lang, rng.randint(1, 40)).upper(), "kept", 0.5) for k, lang in enumerate(list(LETTERS) * 8)]
    profiles = language_id.learn(spark.createDataFrame(labelled, "id long, text string, lang string"), "lang", "text", F.xxhash64("id"), listed=80)
    plain = {lang: rank_order([t for _, t, x in labelled if x == lang], 80) for lang in LETTERS}
    table = spark.createDataFrame(asked, "id long, text string, lang_pred string, score double")
    got = language_id.identify(table, "text", profiles)
    assert got.columns == ["id", "text", "lang_pred", "score"]  # own columns of these names give way
    for r in got.collect():
        own = rank_order([r["text"]], 80)
        far = {lang: sum(abs(plain[lang].index(g) - k) if g in plain[lang] else 80 for k, g in enumerate(own)) for lang in LETTERS}
        first, second = sorted(far.values())[:2]
        assert r["lang_pred"] == min(far, key=lambda x: (far[x], x)) and math.isclose(r["score"], 1 - first / second if second else 0)
    assert language_id.identify(table.limit(0), "text", profiles).count() == 0


def test_token_counts_of_long_texts(monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = str(public.path("byte_bpe_50k.json"))
    texts = [None, "", *("".join(rng.choice(["the ", "<|endoftext|>", "  ", "\n", "漢", "x'll", "12", "a" * 50]) for _ in range(300)) for _ in range(5))]
    whole = token_counts.Counter(path).of(texts)
    monkeypatch.setattr(token_counts, "LONG", 7)
    assert token_counts.Counter(path).of(texts) == whole


def test_token_counts_of_an_empty_table(spark):
    public = pytest.importorskip("public_tokenizers")
    none = spark.createDataFrame([], "doc_id long, text string, n_tokens int")
    assert token_counts.token_counts(none, "doc_id", "text", str(public.path("byte_bpe_50k.json")), 5).count() == 0


def linked(messages):
    """Reply of each (conversation, turn), by comparing every quotation with every earlier message."""
    lines = lambda t: [(0 if not (m := re.match(r"((?:> ?)+)", x)) else m[1].count(">"), " ".join(re.sub(r"^(?:> ?)+", "", x).lower().split())) for x in t.split("\n")]

    def passages(found):
        out, run = set(), []
        for level, x in [*found, (-1, "")]:
            if run and (level != run[0][0] or not x):
                out |= {(run[0][0], " ".join(y for _, y in run))} | set(run)
                run = []
            if x:
                run.append((level, x))
        return out

    own = {k: passages(lines(t)) for k, t in messages.items()}
    out = {}
    for (conv, turn), found in own.items():
        chars = collections.Counter()
        for level, x in found:
            earlier = [b for a, b in own if a == conv and b < turn and (0, x) in own[a, b]]
            if level > 0 and earlier:
                chars[-level, max(earlier)] += len(x)
        out[conv, turn] = max(((level, n, original) for (level, original), n in chars.items()), default=(None,) * 3)[2]
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
def test_quotations_brute_force(spark, kind):
    name = (lambda t: t) if kind == "long" else (lambda t: f"t{t:03d}")
    messages = {}
    for conv in range(6):
        texts = []
        for turn in range(rng.randint(2, 14)):
            text = [words_of(rng.choice(list(LETTERS)), rng.randint(1, 4)) for _ in range(rng.randint(0, 4))]
            for _ in range(rng.randint(0, 2) if texts else 0):
                source = rng.choice(texts).split("\n")
                a = rng.randrange(len(source))
                text += ["", *("> " + x if x.startswith(">") or rng.random() < 0.8 else ">> " + x for x in source[a : a + rng.randint(1, 3)])]
            texts.append("\n".join(text))
            messages[conv, name(turn)] = texts[-1]
    table = spark.createDataFrame([(c, t, "u", x, 1) for (c, t), x in messages.items()], f"conv_id long, turn {kind}, role string, text string, hash int")
    got = {(r["conv_id"], r["turn"]): r for r in quotations.reply_ordered(table).collect()}
    want = linked(messages)
    assert {k: r["reply_to"] for k, r in got.items()} == want
    assert sum(x is not None for x in want.values()) > 10
    for (conv, turn), r in got.items():
        path = [turn]
        while want[conv, path[0]] is not None:
            path.insert(0, want[conv, path[0]])
        assert (r["thread_turn"], r["depth"]) == (path[0], len(path) - 1)


def test_replies_are_taken_apart_again(spark):
    rows = [(1, 0, "u", "Hello\nthere"), (1, 1, "a", " fine "), (1, 2, "u", None), (1, 3, "a", "after null"), (1, 4, "a", "twice"), (1, 4, "b", "twice too"), (1, 5, "a", "x"), (2, 7, None, "alone")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    mail = quotations.as_replies(table)
    assert {r["text"] for r in mail.filter("conv_id = 1 and turn = 2").collect()} == {"\nSomeone wrote:\n>  fine \n> > Hello\n> > there"}
    got = collections.Counter((r["conv_id"], r["turn"], r["text"], r["n_quoted"], r["reply_to"], r["depth"]) for r in quotations.reply_ordered(mail).collect())
    assert got == collections.Counter([(1, 0, "Hello\nthere", 0, None, 0), (1, 1, "fine", 2, 0, 1), (1, 2, "", 3, 1, 2), (1, 3, "after null", 0, None, 0), (1, 4, "twice", 1, 3, 1), (1, 4, "twice too", 1, 3, 1), (1, 5, "x", 0, None, 0), (2, 7, "alone", 0, None, 0)])


def shingles(text, n=2):
    w = (text or "").split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def vertices(rows, percent, n=2):
    """Set size of each row, and the smallest id that its id reaches; an id is one vertex whatever texts it has."""
    label = {i: i for i, _ in rows if i is not None}
    sets = [(i, shingles(t, n)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= percent * len(x | y)]
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return collections.Counter((i, len(x), label.get(i)) for i, x in sets)


def variants(n, words, edits):
    base = [f"w{k}" for k in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for at in rng.sample(range(words), rng.randint(*edits)):
            text[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("sketched", [True, False])
def test_repeated_and_odd_ids(spark, sketched):
    a = variants(1, 60, (0, 0))[0]
    near, b = a.replace("w59", "y"), "b " * 3 + " ".join(f"v{k}" for k in range(60))
    rows = [(5, a), (5, b), (1, b + " z"), (9, near), (9, near), (None, a), (None, None), (7, ""), (7, b + " q"), (8, None), (8, None), (3, "lone")]
    for kind, name in (("long", lambda i: i), ("string", lambda i: None if i is None else f"id {i}"), ("decimal(9,2)", lambda i: None if i is None else __import__("decimal").Decimal(i))):
        named = [(name(i), t) for i, t in rows]
        table = spark.createDataFrame([(*r, 1) for r in named], f"doc_id {kind}, text string, f1 int")
        got = ngram_join.ngram_join(table, "doc_id", "text", n=2, percent=80, sketched=sketched)
        want = vertices(named, 80)
        assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == want
        assert {i: c for i, _, c in want}[name(9)] == name(1)


@pytest.mark.parametrize(("block", "many"), [(1 << 13, 1 << 13), (5, 1 << 13), (5, 3)])
def test_large_blocks_are_split(spark, monkeypatch, block, many):
    """Hot blocks and signatures give the same links by other ways."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "MANY", many)
    texts = [*variants(30, 50, (0, 3)), *variants(40, 50, (2, 9)), *[" ".join(f"u{k + j}" for j in range(40)) for k in range(25)]]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", n=2, percent=80)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == vertices(rows, 80)


def test_hot_owners_are_split(spark, monkeypatch):
    """Phrases that all texts share, with other words around them, give the same ranges in rounds of owners."""
    phrase, tail = words_of("aa", 30), words_of("bb", 12)
    rows = [(k, " ".join([words_of("cc", rng.randint(0, 25)), phrase, words_of("cc", rng.randint(0, 3) and 9), tail[: rng.randint(0, len(tail))]])) for k in range(60)]
    rows += [(60 + k, rows[k][1][5:]) for k in range(12)] + [(3, rows[3][1]), (None, phrase * 3), (90, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    run = lambda: collections.Counter(map(tuple, suffix_dedup.remove_repeats(table, "doc_id", "text", 60).collect()))
    whole = run()
    assert whole == repeats(rows, 60)
    for hot, shard in ((600, 1 << 20), (2000, 500)):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "SHARD", shard)
        assert run() == whole


def test_segments_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    monkeypatch.setattr(base.pieces, "__defaults__", (500,))
    part = words_of("aa", 150)
    rows = [(1, words_of("bb", 300) + part + words_of("cc", 200)), (2, words_of("cc", 40) + part), (3, "short"), (4, words_of("bb", 900))]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 60).collect()
    assert collections.Counter(map(tuple, got)) == repeats(rows, 60)


def test_vectors_of_several_dimensions(spark):
    gen = np.random.default_rng(8)
    vectors = [(k, (gen.normal(size=d) if k % 3 else np.ones(d) + gen.normal(size=d) * 0.1).astype(np.float32).tolist()) for k, d in enumerate([2, 3, 7] * 40)]
    vectors += [(200, [1e30, 1e30]), (201, [1e-30, 1e-30]), (202, [3.0, 3.0]), (203, [0.0, -0.0]), (204, [float("inf"), 1.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.near_duplicates(spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<float>, no int"), "vec_id", "embedding").collect()}
    x = {k: np.array(v, np.float32).astype(np.float64) for k, v in vectors}
    far = {k: v / np.linalg.norm(v) for k, v in x.items() if np.isfinite(v).all() and np.any(v)}
    links = {a: {b for b in far if b != a and len(far[a]) == len(far[b]) and far[a] @ far[b] >= 0.9} for a in far}
    label = {k: k for k in x}
    for _ in x:
        label |= {a: min([label[a], *[label[b] for b in links[a]]]) for a in links}
    assert got == {k: (len(links.get(k, ())), label[k]) for k in x}


def contained(text, items, size, slop=None):
    """Words, hit words and items of a text, window by window."""
    pattern = r"[a-z0-9]+"
    own, hit, names = re.findall(pattern, (text or "").lower()), set(), set()
    for i, t in items:
        w = re.findall(pattern, (t or "").lower())
        for k in range(max(1, len(w) - size + 1)) if w else ():
            x = w[k : k + size]
            for p in range(len(own) - len(x) + 1):
                if own[p : p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    names.add(str(i))
    return len(own), len(hit), len(names), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_positional_index(spark, block_bytes):
    """Frequent terms, repeated terms, windows that overlap, and own columns of the names that are used inside."""
    words = ["the", "of", "a", *[f"t{k}" for k in range(12)]]
    text = lambda n: " ".join(rng.choices(words, weights=[30, 15, 10, *[2] * 12], k=n))
    items = [(k, text(rng.randint(0, 9))) for k in range(40)] + [(90, "the the the"), (91, "the"), (92, None), (7, "of a")]
    rows = [(k % 50, text(rng.choice([0, 1, 3, 8, 60]))) for k in range(80)] + [(60, "The THE, the!"), (None, "of a t1"), (61, None)] + [(62 + k, items[k][1]) for k in range(9)]
    table = spark.createDataFrame([(*r, 1, "h", 2, "x", 3) for r in rows], "doc_id long, text string, n_words int, hits string, w int, item string, row int").repartition(3)
    asked = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, n int")
    found = decontaminate.matches(table, "text", asked, "item_id", "text", size=4, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "text", "w", "item", "row", "n_words", "hits"]
    got = collections.Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.digest(found, "doc_id").collect())
    assert got == collections.Counter((i, *contained(t, items, 4)) for i, t in rows)
    for r in found.filter("size(hits) > 0").collect():
        own = re.findall(r"[a-z0-9]+", r["text"].lower())
        for h in r["hits"]:
            spans = [tuple(s) for s in h["spans"]]
            assert spans == sorted(spans) and all(a < b <= len(own) for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_proximity_stays_in_its_text(spark):
    texts = [(k, " ".join(rng.choices(["a", "b", "c", "x", "y"], k=rng.randint(1, 12)))) for k in range(120)]
    docs = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    found = decontaminate.matches(docs, "text", spark.createDataFrame([(1, "a b c")], "item long, text string"), "item", "text", 3, slop=1)
    counts = collections.Counter(w for _, t in texts for w in t.split())
    rare = min(range(3), key=lambda k: (counts["abc"[k]], abs(k - 1), k))
    want = set()
    for i, t in texts:
        own = t.split()
        at = lambda k, own=own: {p for p, w in enumerate(own) if w == "abc"[k]}
        if any(all(any(abs(q - (p + k - rare)) <= 1 for q in at(k)) for k in range(3)) for p in at(rare)):
            want.add(i)
    assert {r["id"] for r in found.filter("size(hits) > 0").collect()} == want


BLOCK_TAGS = ["h2", "h3", "p", "blockquote", "pre", "address", "center", "h4", "h5", "h6"]


def host_pages(n):
    """Pages of one template: for each place its tag and whether its text is the host's, the page's own, or now and then there."""
    places = [(tag, rng.choice(["fixed", "own", "some fixed", "some own", "many own"])) for tag in rng.sample(BLOCK_TAGS, rng.randint(1, 7))]
    pages = []
    for k in range(n):
        blocks = []
        for tag, kind in places:
            if kind.startswith("some") and rng.random() < 0.5:
                continue
            for j in range(rng.randint(2, 4) if kind.startswith("many") else 1):
                blocks.append((tag, f"{tag} of all" if kind.endswith("fixed") else f"{tag} {k} {j} {rng.randrange(10**6)}"))
        pages.append(blocks)
    return pages


@pytest.mark.parametrize("copies", [1, 2])
def test_alignment_decides(spark, copies):
    """A text that different pages of a host have in one place is the host's; all others are the page's own."""
    rows, want = [], {}
    for host in range(40):
        pages = host_pages(rng.randint(1, 6)) * copies
        for blocks in pages:
            places = {tag: {(x, tuple(other)) for other in pages for t, x in other if t == tag} for tag, _ in blocks}
            fixed = {tag for tag, found in places.items() if len({x for x, _ in found}) == 1 and len({page for _, page in found}) > 1}
            want[len(rows)] = "\n".join(x for tag, x in blocks if tag not in fixed)
            rows.append((len(rows), f"http://h{host}.example/x", "<html><body>" + "".join(f"<{tag}>{x}</{tag}>" for tag, x in blocks), "w", 1))
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host string, wrapper int").repartition(5)
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(table, "page_id", "url", "html").collect()}
    assert got == want
    assert any(want[k] != re.sub("<[^>]*>", "\n", r[2]).strip() for k, r in enumerate(rows))


def brute_match(a, b):
    best = {}
    for i in range(len(a), -1, -1):
        for j in range(len(b), -1, -1):
            best[i, j] = 0 if i == len(a) or j == len(b) else best[i + 1, j + 1] + 1 if a[i] == b[j] else max(best[i + 1, j], best[i, j + 1])
    return best[0, 0]


def test_longest_common_subsequences():
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        pairs = wrappers.matched(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) == brute_match(a, b)


def test_pages_that_name_their_parts(spark):
    deep = "<div>" * 5000
    cases = {
        "<main><p>intro</p><article><p>teaser</p></article></main>": "intro\nteaser",
        '<div id="post-sidebar-wide" class="content">kept</div>': "kept",
        '<div class="text share">kept</div>': "kept",
        '<div class="side">kept</div>': "kept",
        '<div class="sidebar"><p>all there is</p></div>': "all there is",
        '<div class="sidebar"><p>out</p></div><p>kept</p>': "kept",
        '<div class="widget-area"><h1>Head</h1><p>kept</p></div><div class="site-footer"><h1>out</h1></div>': "Head\nkept",
        '<article></article><div class="ad">out</div>': "",
        '<article><p>kept</p><div class="comments-area"><article>out</article></div></article>': "kept",
        '<article class="share"><p>kept</p></article><article class="comment">out</article>': "kept",
        "<ul><li><a href=x>out</a><li><a href=y>out too</a></ul><p>kept <a href=z>link</a></p>": "kept link",
        f"{deep}kept{'</div>' * 5000}": "kept",
        "</p>" * 3000 + "<b>kept": "kept",
        '<div role="navigation">out</div><header>out</header><p>kept': "kept",
    }
    rows = [(k, f"http://h{k}/", html) for k, html in enumerate(cases)] + [(100 + k, "http://same/", "<p>Same para</p>") for k in range(3)] + [(100, "http://same/", "<p>Same para</p>"), (None, None, "<p>x"), (200, "http://n/", None)]
    got = collections.Counter((r["page_id"], r["text"], r["n_chars"]) for r in wrappers.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html").collect())
    want = [(k, text, len(text)) for k, text in enumerate(cases.values())] + [(100 + k, "Same para", 9) for k in (0, 0, 1, 2)] + [(None, "x", 1), (200, "", 0)]
    assert got == collections.Counter(want)
