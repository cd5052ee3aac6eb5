"""Operators against brute force, on small tables with nulls, empty, long, tied and repeated rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import decontaminate, embedding_join, language_id, mixing, ngram_join, quotations, suffix_dedup, token_counts, warc, wrappers

rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("aeiou" if k % 2 else "bcdfglmnprst") for k in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, k):
    words = text.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = "X" + rng.choice(VOCABULARY)
    return " ".join(words)


BASES = [prose(n) for n in (40, 90, 300)]
TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "one two",
    "ONE two",
    "one two three",
    *BASES,
    BASES[0],
    *[edited(b, k) for b in BASES for k in (1, 2, 3, 8)],
    prose(30) + " " + BASES[2] + " " + prose(5),
    BASES[1] + BASES[1],
    "the " * 300,
    prose(9000),
    "日本語 テキスト ünïcödé " * 20,
    "日本語 テキスト ünïcödé " * 20 + "!",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, k1 int, hits int, kept int"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use inside."""
    rows = [(k, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", len(t or ""), "x", 1, 2, 3, 4) for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (900, None, None, None, None, None, None, None, None, None), rows[8]], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def classes(texts, n, percent):
    """component and set size by id."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(docs, rows, n, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(docs, "doc_id", "text", n, percent).collect()}
    assert got == classes(rows, n, percent)


def test_signatures_and_tries_miss_nothing():
    gen = np.random.default_rng(3)
    for percent in (50, 80, 90):
        bands = ngram_join.Bands(percent)
        for _ in range(60):
            base = gen.integers(0, 2**63, int(gen.integers(1, 150))).astype(np.uint64)
            sets = [np.unique(base)]
            for _ in range(6):
                k = int(gen.integers(0, len(base) // 5 + 2))
                kept = base[gen.random(len(base)) > k / (len(base) + 1)]
                sets.append(np.unique(np.concatenate((kept if len(kept) else base[:1], gen.integers(0, 2**63, k).astype(np.uint64)))))
            sets = list({s.tobytes(): s for s in sets}.values())
            signs, sketches = [set(ngram_join.signatures(s, bands).tolist()) for s in sets], ngram_join.folded([ngram_join.parity_sketch(s) for s in sets])
            label = list(range(len(sets)))
            for i in range(len(sets)):
                for j in range(i):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        assert signs[i] & signs[j]
                        label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
                    assert np.bitwise_count(sketches[i] ^ sketches[j]).sum() <= len(sets[i]) + len(sets[j]) - 2 * both
            assert ngram_join.block_components(list(range(len(sets))), sets, percent) == label


def brute_labels(sets, percent):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return label


def test_blocks_of_drifting_chains():
    """The largest component changes while the block is probed."""
    gen = np.random.default_rng(11)

    def edit(s, k):
        return np.unique(np.concatenate((gen.permutation(s)[k:], gen.integers(0, 2**63, k).astype(np.uint64))))

    for _ in range(400):
        sets = [np.unique(gen.integers(0, 2**63, 40).astype(np.uint64))]
        while len(sets) < int(gen.integers(4, 30)):
            far = gen.random() < 0.2
            sets.append(edit(sets[int(gen.integers(len(sets)))] if far else sets[-1], 4 if far else int(gen.integers(1, 7))))
        for percent in (60, 80):
            assert ngram_join.block_components(list(range(len(sets))), sets, percent) == brute_labels(sets, percent)


class Links:
    """In place of a trie: row r is similar to the rows that `links` names, and frequencies give the order of probes."""

    def __init__(self, links, central):
        n = len(central)
        self.order, self.members = np.arange(n), np.arange(n)
        self.flat = np.repeat(np.arange(n), central)
        self.offset = np.concatenate(([0], np.cumsum(central)))
        self.near = [np.array(sorted({r} | {a + b - r for a, b in links if r in (a, b)})) for r in range(n)]

    def similar(self, r, percent):
        return self.near[r]


def test_two_bridged_hubs(monkeypatch):
    p, r, q1, q2, s1, s2, s3 = range(7)
    links = [(p, q1), (p, q2), (r, s1), (r, s2), (r, s3), (q1, s1)]
    monkeypatch.setattr(ngram_join, "Trie", lambda _: Links(links, [9, 8, 2, 2, 1, 1, 1]))
    assert ngram_join.block_components(list(range(7)), [None] * 7, 80) == [0] * 7


def test_first_probe_alone(monkeypatch):
    monkeypatch.setattr(ngram_join, "Trie", lambda _: Links([(0, 2), (2, 3), (2, 4), (3, 4)], [2, 9, 1, 8, 1]))
    assert ngram_join.block_components(list(range(5)), [None] * 5, 80) == [0, 1, 0, 0, 0]


def repeats(texts, width):
    starts = collections.Counter()
    raw = [(t or "").encode() for _, t in texts]
    for b in raw:
        starts.update(b[k : k + width] for k in range(len(b) - width + 1))
    out = collections.Counter()
    for (i, _), b in zip(texts, raw, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if starts[b[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("width", [200, 50])
def test_suffix_dedup(docs, rows, width):
    got = suffix_dedup.remove_repeats(docs, "doc_id", "text", width).collect()
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == repeats(rows, width)


def test_suffix_arrays():
    gen = random.Random(1)
    for trial in range(30):
        data = bytes(gen.choice(b"abc" if trial % 2 else b"a") for _ in range(gen.randint(1, 200))) * (1 + trial % 3)
        x = np.frombuffer(data, np.uint8)
        order = suffix_dedup.suffix_array(x, 1 << 20)
        want = sorted(range(len(data)), key=lambda k: data[k:])
        assert order.tolist() == want
        prefix = suffix_dedup.common_prefixes(x, order)
        for k in range(1, len(data)):
            a, b = data[want[k - 1] :], data[want[k] :]
            assert prefix[k] == next((n for n, (p, q) in enumerate(zip(a, b, strict=False)) if p != q), min(len(a), len(b)))


def test_shards_merge_by_binary_search():
    text = prose(200).encode()
    contexts = [text[k : k + 400] for k in (0, 100, 200)]
    one = suffix_dedup.Shard(contexts, np.array([201] * 3), 200)
    a, b = suffix_dedup.Shard(contexts[:1], np.array([201]), 200), suffix_dedup.Shard(contexts[1:], np.array([201] * 2), 200)
    a.merge(b)
    assert list(a.ranges()) + [(k + 1, x, y) for k, x, y in b.ranges()] == list(one.ranges())


def hits(text, items, size):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    own, hit, names = words(text), set(), set()
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            x = w[k : k + size]
            for p in range(len(own) - len(x) + 1):
                if own[p : p + len(x)] == x:
                    hit.update(range(p, p + len(x)))
                    names.add(str(i))
    return len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, rows, block_bytes):
    items = [(10, " ".join(BASES[2].split()[20:45])), (9, "One, TWO three!"), (8, None), (7, "..."), (6, " ".join(BASES[0].split()[3:13])), (6, " ".join(BASES[0].split()[3:13])), (None, "the the")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.digest(decontaminate.matches(docs.select("doc_id", "text"), "text", table, "item_id", "text", 10, block_bytes=block_bytes), "doc_id").collect()
    named = [("" if i is None else i, t) for i, t in items]
    assert collections.Counter(tuple(r) for r in found) == collections.Counter((i, *hits(t, named, 10)) for i, t in rows)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b c"), (2, "a x x x x b c"), (3, "c b a")], "id int, text string")
    items = spark.createDataFrame([(1, "a b c")], "item long, text string")
    near = decontaminate.matches(docs, "text", items, "item", "text", 3, slop=2)
    assert {r["id"] for r in near.filter(F.size("hits") > 0).collect()} == {1, 3}
    assert decontaminate.matches(docs, "text", items, "item", "text", 3).filter(F.size("hits") > 0).count() == 0


def test_mixing(docs):
    got = mixing.mix_sources(docs, "doc_id", "source", "text", block=2, shard=500).collect()
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(TEXTS)} | {900: 0}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["source"], [r["source_size"], r["target"], 0])[2] += r["taken"]
    total = sum(x[0] for x in by.values())
    assert sum(x[1] for x in by.values()) == pytest.approx(total)
    assert all(abs(t - taken) <= 2 * (2 + n / 500 + 2) and t <= 3 * n + 1e-6 for n, t, taken in by.values())
    weights = dict(zip(sorted(by, key=lambda s: (s is None, s or "")), (5, 2, 1, 5), strict=False))
    level = {t / weights[s] for s, (n, t, _) in by.items() if t < 3 * n - 1e-6}
    assert max(level) - min(level) < 1e-6 * max(level) and all(t <= weights[s] * max(level) + 1e-6 for s, (n, t, _) in by.items())
    again = mixing.mix_sources(docs.repartition(5), "doc_id", "source", "text", block=2, shard=500).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))
    wide = mixing.mix_sources(docs, "doc_id", "source", "text", with_row=True)
    assert {"mix_size", "size", "taken", "k1"} <= set(wide.columns) and wide.count() == len(got)


def test_apportionment(spark):
    """Sainte-Lague, seat by seat."""
    gen = random.Random(5)
    parties = [(g, p, gen.randint(0, 1000)) for g in range(8) for p in range(gen.randint(1, 9))]
    seats = {g: gen.randint(0, 60) for g in range(8)}
    df = spark.createDataFrame([(g, p, v, seats[g]) for g, p, v in parties], "g int, p int, v long, seats long")
    got = {(r["g"], r["p"]): r["won"] for r in mixing.apportion(df, ["g"], ["p"], "v", "seats", "won").collect()}
    for g in range(8):
        own = [(p, v) for x, p, v in parties if x == g]
        won = dict.fromkeys((p for p, _ in own), 0)
        for _ in range(seats[g] if any(v for _, v in own) else 0):
            best = max(own, key=lambda x: (x[1] / (2 * won[x[0]] + 1), -x[0]))
            won[best[0]] += 1
        assert {p: got[g, p] for p, _ in own} == won


def test_token_counts(docs, rows):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(public.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    want = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    got = token_counts.token_counts(docs, "doc_id", "text", path, 100).collect()
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == collections.Counter((i, len((t or "").encode()), want(t), want(t) > 100) for i, t in rows)
    counter, gen = token_counts.Counter(path), random.Random(2)
    odd = ["".join(gen.choice(["the", "<|endoftext|>", "'ll", " ", "\n", "\t", "\x1c", "　", "漢", "🙂", "²", "aaaa", "\x00", "é"]) for _ in range(gen.randint(0, 40))) for _ in range(200)] + ["a" * 3000, " " * 500]
    assert counter.of(odd) == [want(t) for t in odd]


def test_language_id(spark, docs):
    de, en = ["der", "und", "schule", "nicht", "ich"], ["the", "and", "school", "not", "with"]
    labelled = spark.createDataFrame([(k, " ".join(rng.choice(w) for _ in range(40)), lang) for k in range(40) for w, lang in ((de, "de"), (en, "en"))] + [(1, None, "xx"), (2, "text", None)], "id long, text string, lang string")
    profiles = language_id.learn(labelled, "lang", "text", F.xxhash64("id"))
    assert profiles.languages == ["de", "en"]
    texts = spark.createDataFrame([(1, "the school and"), (2, "Schule und nicht"), (3, None), (4, "123 !"), (5, ""), (6, "the " * 50_000)], "id long, text string")
    got = {r["id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(texts, "text", profiles).collect()}
    assert [got[k][0] for k in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    nothing = language_id.learn(labelled.limit(0), "lang", "text", F.xxhash64("id"))
    assert {r["lang_pred"] for r in language_id.identify(texts, "text", nothing).collect()} == {"und"}


def test_warc_round_trip(spark, tmp_path):
    body = [prose(40).encode().decode() for _ in range(30)]
    pages = [(k, f"http://h/{k}?ü={k}", body[k % 20] if k % 9 else None) for k in range(60)] + [(None, None, body[1]), (5, "http://h/5", body[5])]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/archives"
    assert warc.write_archives(table, folder) == len(pages)
    got = collections.Counter((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, folder).collect())
    first = {}
    for i, _, h in pages:
        first[h or ""] = min((x for x in (first.get(h or ""), i) if x is not None), default=None)
    want = collections.Counter()
    for i, _, h in pages:
        f = first[h or ""]
        want[None if i is None else str(i), len((h or "").encode()), warc.base32_sha1((h or "").encode()), "response" if i == f else "revisit", None if i == f else str(f)] += 1
    assert got == want
    payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, folder).filter("record_type = 'response'").collect()}
    assert payloads["1"] == body[1]
    assert warc.write_archives(table.limit(0), f"file://{tmp_path}/none") == 0 and warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_warc_dictionary_and_damage():
    samples = [f"<html><p>{prose(300)}</p></html>".encode() for _ in range(200)]
    writer = warc.Writer(samples)
    head = {"WARC-Record-ID": "<urn:page:1>", "WARC-Date": "1970-01-01T00:00:00Z"}
    for s in samples:
        writer.add(warc.record("response", head, s))
    archive = writer.bytes()
    assert int.from_bytes(archive[:4], "little") == warc.SKIPPABLE
    assert [b for _, b in warc.records(archive)] == samples
    for bad in (archive[:-3], archive + b"x", archive[:9]):
        with pytest.raises((warc.FormatError, warc.zstandard.ZstdError)):
            list(warc.records(bad))
    with pytest.raises(warc.FormatError):
        warc.parse(warc.record("response", head, b"abc")[:-1])
    with pytest.raises(warc.FormatError):
        warc.parse(b"WARC/1.1\r\nWARC-Type: x\r\n\r\n\r\n\r\n")


def test_quotations(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?"), (1, 1, "a", "> Hello there\nHi!"), (1, 2, "u", "Bob wrote:\n> Hi!\n>> Hello there\n\nGreat"), (1, 3, "a", "> How ARE  you?\nfine"), (1, 4, "u", None), (1, 5, "a", "> Great\nyes"), (None, 1, "u", "x"), (2, 0, None, ""), (1, 3, "a", "> How ARE  you?\nfine")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("units", F.lit(1))
    got = collections.Counter((r["conv_id"], r["turn"], r["text"], r["reply_to"], r["thread_turn"], r["depth"]) for r in quotations.reply_ordered(table).collect())
    assert got == collections.Counter([(1, 0, "Hello there\nHow are you?", None, 0, 0), (1, 1, "Hi!", 0, 0, 1), (1, 2, "Great", 1, 0, 2), (1, 3, "fine", 0, 0, 1), (1, 3, "fine", 0, 0, 1), (1, 4, "", None, 4, 0), (1, 5, "yes", 2, 0, 3), (None, 1, "x", None, 1, 0), (2, 0, "", None, 0, 0)])
    assert quotations.reply_ordered(table.limit(0)).count() == 0


def test_nested_quotations(spark):
    """Deeper levels link where level 1 has no original, the lowest first, and never outvote it."""
    rows = [(0, "A long first message"), (1, "> A long first message\nmiddle"), (2, "> > A long first message\nonly deep"), (3, "> trimmed away\n>> middle\n>>> A long first message\nx"), (4, "> middle\n>> A long first message\ny"), (5, ">> never said\nz")]
    table = spark.createDataFrame([(1, k, "u", t) for k, t in rows], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["reply_to"], r["thread_turn"], r["depth"]) for r in quotations.reply_ordered(table).collect()}
    assert got == {0: (None, 0, 0), 1: (0, 0, 1), 2: (0, 0, 1), 3: (1, 0, 2), 4: (1, 0, 2), 5: (None, 5, 0)}


def test_embedding_join(spark):
    gen = np.random.default_rng(2)
    centres = gen.normal(size=(40, 16))
    vectors = [(c + gen.normal(size=16) * s).tolist() for c in centres for s in (0.05, 0.2, 0.25)] + [centres[0].tolist()] * 5
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, *[None] * 15], [1.0]]  # the last: alone in its dimension
    rows = [(k, v) for k, v in enumerate(vectors + odd)] + [(None, vectors[0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()}
    x = np.array([*vectors, vectors[0]])  # the last has a null id: it counts, and takes the component of the others
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min(label[k], label[near[k]].min(initial=label[k])) for k in range(len(x))])
    for k in range(len(vectors)):
        assert got[k] == (near[k].sum(), label[k], label[k] == k)
    assert got[None] == (near[-1].sum(), label[-1], False)
    assert all(got[k] == (0, k, True) for k in range(len(vectors), len(vectors) + len(odd)))
    assert embedding_join.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding").count() == 0


def test_metric_cells(monkeypatch, spark):
    """Many small cells give what one gives."""
    gen = np.random.default_rng(4)
    x = np.repeat(gen.normal(size=(60, 8)), 5, axis=0) + gen.normal(size=(300, 8)) * 0.15
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    run = lambda: {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.near_duplicates(table, "vec_id", "embedding").collect()}
    one = run()
    for cell, rows in ((64 * 8 * 2, 256), (20 * 64, 3)):
        monkeypatch.setattr(embedding_join, "CELL", cell)
        monkeypatch.setattr(embedding_join, "ROWS", rows)
        monkeypatch.setattr(embedding_join, "_natives", lambda d: max(16, embedding_join.CELL // (8 * d)))
        assert run() == one


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><h1>{0} &amp; co</h1><p><b>First{0}.<br><p>Second <i>par</i>t &lt;3&nbsp;.</p>{1}</article><div class="comments"><p>me too</p></div><form>x</form><footer>&copy; host</footer>"""


def test_wrappers(spark):
    pages = [(k, "http://h.example/x", PAGE.format(k, "<ul><li>a<li>b</ul>" if k % 2 else "")) for k in range(6)]
    pages += [(10, None, None), (11, "::", ""), (12, "http://o.example", "<main><p>m</main><p>out"), (13, "http://p.example", "plain text"), (14, "http://q.example", "<p " * 2000 + "<article>" + "<p>w" * 3000)]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), "page_id", "url", "html").collect()}
    for k in range(6):
        assert got[k][0] == f"{k} & co\nFirst{k}.\nSecond part <3 ." + ("\na\nb" if k % 2 else "")
        assert got[k][1] == len(got[k][0])
    assert got[10] == got[11] == ("", 0) and got[12][0] == "m" and got[13][0] == "plain text"
    few = wrappers.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"), "page_id", "url", "html", broadcast_bytes=0)
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in few.collect()} == got


def test_wrapper_expression():
    a = wrappers.items_of(wrappers.parse("<div><h1>x</h1><p>1</p><p>2</p></div>"))
    b = wrappers.items_of(wrappers.parse("<div><p>1</p><hr><ul><li>q</ul></div>"))
    assert wrappers.expression(wrappers.align(a, b)) == "<div> ( <h1> #text </h1> )? ( <p> #text </p> )+ ( <ul> <li> #text </li> </ul> )? </div>"
    twice = wrappers.items_of(wrappers.parse("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))
    assert wrappers.expression(twice) == "<dl> ( <dt> #text </dt> <dd> #text </dd> )+ </dl>"


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.ngram_join(none, "doc_id", "text").count() == 0
    assert suffix_dedup.remove_repeats(none, "doc_id", "text").count() == 0
    assert mixing.mix_sources(none, "doc_id", "source", "text").count() == 0
    assert decontaminate.matches(none.select("doc_id", "text"), "text", items, "item_id", "text").count() == 0
    assert decontaminate.matches(docs.select("doc_id", "text"), "text", items, "item_id", "text").filter(F.size("hits") > 0).count() == 0
    assert wrappers.main_text(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "url", "html").count() == 0
