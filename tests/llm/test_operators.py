"""Corpus operators against brute force on small frames with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pitfeat.llm import (
    bpe_codec,
    decontaminate,
    html_text,
    language_id,
    lm_score,
    ngram_join,
    quality_net,
    quality_rules,
    token_counts,
    warc,
)
from pitfeat.llm.common import id_bucket
from pitfeat.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, score double, key string, row long"
WORDS = "the of and to stone river light house seven green walked under old bridge with many small fish".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [prose(i, 60 + 7 * i) for i in range(12)]
    near = base[3].split()
    near[10] = "changed"
    out = [*base, base[0], " ".join(near), base[5].upper(), None, "", "   \n ", "one two", "one two", "É à <|endoftext|> 漢字 😀",
           "a b c " * 40, "same line\nsame line\nother", "x" * 3000, " ".join(base) * 3]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else "fr", 0.5, "k", 7) for i, t in texts]
    rows.append(rows[1])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().split()


def test_quality_rules(docs, empty, texts):
    got = {r.doc_id: r for r in quality_rules.apply_policy(quality_rules.ledger(docs), "v2").collect()}
    for i, t in texts:
        t = t or ""
        w = split(t)
        places = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        hit = {k + o for k in range(len(w) - 2) if places[tuple(w[k:k + 3])] > 1 for o in range(3)}
        lines = [x for x in t.split("\n") if split(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in quality_rules.SYMBOLS),
            len(lines) - len(set(lines)), len(hit)), i
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality_rules.ledger(docs).count() == len(texts) + 1
    assert quality_rules.ledger(empty).count() == 0
    book = quality_rules.ledger(docs)
    masks = [r.fail_bits for r in book.collect()]
    for r in quality_rules.ablations(book, "v2").collect():
        bit, full = quality_rules.bit(r.rule), quality_rules.mask("v2")
        assert (r.failed, r.failed_alone, r.kept_without) == (
            sum(m & bit > 0 for m in masks), sum(m & full == bit for m in masks),
            sum(m & full & ~bit == 0 for m in masks))


def test_token_counts(docs, empty, texts):
    path = vocabulary()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in token_counts.token_counts(docs, path).collect()}
    for i, text in texts:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((text or "").encode()), n > 512)
    assert token_counts.token_counts(docs, path).count() == len(texts) + 1
    assert token_counts.token_counts(empty, path).count() == 0


def test_bpe_round_trip(docs, empty, texts):
    path = vocabulary()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in bpe_codec.round_trip(docs, path).collect()}
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        again = t.decode(ids, skip_special_tokens=False)
        assert got[i].decoded_sha256 == hashlib.sha256(again.encode()).hexdigest() and again == (text or "")
    coded = bpe_codec.encode(docs, path)
    assert coded.where("not exact").count() == 0
    back = {r.doc_id: r.text for r in bpe_codec.decode(coded, path).collect()}
    assert all(back[i] == (x or "") for i, x in texts)
    assert bpe_codec.encode(empty, path).count() == 0


def test_suffix_automaton():
    from pitfeat.llm.suffix_automaton import SuffixAutomaton

    r = random.Random(1)
    for _ in range(200):
        tokens = {bytes(r.choice(b"abc") for _ in range(r.randrange(1, 7))) for _ in range(r.randrange(1, 25))}
        number = {t: i for i, t in enumerate(tokens)}
        a = SuffixAutomaton(number.items())
        text = bytes(r.choice(b"abcd") for _ in range(60))
        for at, state in enumerate(a.ends(text), 1):
            want = [(number[t], len(t)) for t in sorted(tokens, key=len, reverse=True) if text[:at].endswith(t)]
            assert list(a.suffixes(state)) == want


def test_bpe_on_random_strings():
    c, r = bpe_codec.codec(vocabulary()), random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice("aabeethnio  \n\t'stREé–漢😀12!=-_") for _ in range(r.randrange(30)))
        assert c.encode(text) == c.splitter.tokenizer.encode(text, add_special_tokens=False).ids


def jaccard_groups(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low = min(root[a], root[b])
                    changed |= (root[a], root[b]) != (low, low)
                    root[a] = root[b] = low
    return {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("settings", [{}, {"block": 150, "frequent_share": 1, "frequent_from": 2}])
def test_ngram_join(docs, empty, texts, settings):
    want = jaccard_groups(texts)
    got = ngram_join.similar_groups(docs, **settings).collect()
    assert len(got) == len(texts) + 1
    assert all(want[r.doc_id] == (r.n_shingles, r.component_id) for r in got)
    kept = sorted(r.doc_id for r in ngram_join.keep_one(docs, **settings).collect())
    assert kept == sorted({c for _, c in want.values()})
    if not settings:
        assert ngram_join.similar_groups(empty).count() == 0


def test_prefix_tree_family_of_copies():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**62, 80)
    sets = []
    for _ in range(60):
        x = base.copy()
        k = int(r.integers(0, 12))
        x[r.integers(0, 80, k)] = r.integers(0, 2**62, k)
        sets.append(np.unique(x).astype(np.uint64))
    root = list(range(60))

    def find(i):
        return i if root[i] == i else find(root[i])

    links = ngram_join.spanning_links(sets)
    for a, b in links:
        assert find(a) != find(b)
        root[find(a)] = find(b)
    for a in range(60):
        for b in range(a):
            x, y = set(sets[a].tolist()), set(sets[b].tolist())
            if 100 * len(x & y) >= 80 * len(x | y):
                assert find(a) == find(b)


def test_decontaminate(spark, docs, empty, texts):
    base = dict(texts)
    passage = " ".join(base[2].split()[5:25])
    items = [("a", passage), ("b", passage.upper()), ("c", "one two"), ("d", "never seen words here"), ("e", None),
             ("f", "..."), (None, base[4][:200]), ("a", passage)]
    bench = spark.createDataFrame(items, "item_id string, text string")

    def words(t):
        t = (t or "").translate({c: c + 32 for c in range(65, 91)})
        import re

        return [x for x in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", t) if x]

    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for name, item in items:
            v = words(item)
            n = min(10, len(v))
            grams = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1):
                if n and tuple(w[p:p + n]) in grams:
                    hit |= set(range(p, p + n))
                    found.add(name or "")
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (len(w), len(hit), sorted(found)), i
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert left == {i for i in got if got[i].n_hit == 0}
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_warc_round_trip(spark, tmp_path):
    trap = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(1, "http://a/", "hello"), (2, None, "hello"), (3, "u\r\nv", trap + "tail" + trap), (4, "x", None),
             (5, "y", ""), (6, "z", "é😀" * 50), (7, "w", "WARC/1.0\r\n" * 30), (9, "q", "one"), (9, "q", "one")]
    pages += [(100 + i, f"p{i}", f"page {i} " * (i % 40 + 1)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = str(tmp_path / "w")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200b", "1000b", old):  # splits that cut records and version lines
            warc.write_archives(df.coalesce(2), folder)
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = warc.read_archives(spark, folder)
            rows = found.collect()
            assert len(rows) == len(pages)
            body = {p: (h or "").encode() for p, _, h in pages}
            assert all(bytes(r.payload) == body[int(r.id)] for r in rows if r.type == "response")
            report = warc.page_report(found, df.schema["page_id"].dataType).collect()
            got = {(r.page_id, r.record_type, r.refers_to) for r in report}
            assert {(1, "revisit", 2), (2, "response", None), (4, "revisit", 5), (9, "revisit", 9)} <= got
            import base64

            for r in report:
                assert r.payload_bytes == len(body[r.page_id])
                assert r.payload_digest == base64.b32encode(hashlib.sha1(body[r.page_id]).digest()).decode()
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    warc.write_archives(df.limit(0), folder)
    assert warc.read_archives(spark, folder).count() == 0


def test_warc_trap_before_a_broken_header(spark, tmp_path):
    trap = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    broken = ["WARC/1.0\r\nno colon\r\n\r\nx", "WARC/1.0\r\n", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"]
    pages = [(i, f"u{i}", f"{k}{trap}{b} tail") for i, (k, b) in enumerate((k, b) for k in ("", "head ") for b in broken)]
    pages += [(10 + i, f"p{i}", f"page {i}") for i in range(10)]
    folder = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), folder)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200b", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {int(r.id): bytes(r.payload).decode() for r in warc.read_archives(spark, folder).collect()}
            assert got == {i: h for i, _, h in pages}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_html_text(spark):
    long = "This is the story of a man and of the sea that was all of his life and it is as long as it has to be. " * 3
    cases = {
        f"<nav><a href=x>Home</a></nav><article><h1>T &amp; t</h1><p>{long}<br>x<p>Short</article><footer>f</footer>":
            "T & t " + long.strip() + " x Short",
        f"<header>Top</header><div class='cookie'>{long}</div><p>{long}</p><div id=comments><p>{long}</p></div>": long.strip(),
        "<script>var a='<p>no</p>'</script>": "", "": "", "<p": "", "<article>a<b>b</b>c</article>": "abc",
    }
    for html, want in cases.items():
        assert html_text.main_text(html) == want, html
    df = spark.createDataFrame([(1, "u", None), (2, None, "<main>x</main>"), (2, None, "<main>x</main>")],
                               "page_id long, url string, html string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()) == [
        (1, "", 0), (2, "x", 1), (2, "x", 1)]


def test_html_text_of_other_pages():
    long = "This is the story of a man and of the sea that was all of his life and it is as long as it has to be. " * 3
    foreign = ["Мы шли вдоль реки до старого моста, где рыбаки ждали рассвета. " * 6, "河流在石桥下面静静流过许多年," * 20,
               "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura. " * 6]
    for text in foreign:
        page = f"<nav><a href=x>Home</a></nav><div><p>{text}</p><p>{text}</p></div><div class=footer>{text}</div>"
        assert html_text.main_text(page) == f"{text.strip()} {text.strip()}"
    codes = "AX3 KD9 RT7 QW2 ZP5 LM8 VB4 NC6 HJ1 " * 4
    comments = f"<div id=comments><article>{long}</article></div>"
    want = long.strip()
    cases = {
        f"<p>{long}</p><p>{codes}</p>": want,  # stop words still tell junk on an English page
        f"<div class='layout with-sidebar'><article><p>{long}</p></article><div class=sidebar>{long}</div></div>": want,
        f"<main><h1>Title</h1><div class='comment-page'><article><p>{long}</p></article></div></main>": "Title " + want,
        f"<div id=share-root><main><p>{long}</p>{comments}</main></div>": want,
        f"<article><p>{long}</p></article>{comments}": want,
        f"<div class=with-sidebar><article><p>{long}</p>{comments}</article></div>": want,
        f"<article><h1><a href=x>Title</a></h1><p>{long}</p><p><a href=y>{long}</a></p></article>": "Title " + want,
        f"<div class=with-sidebar hidden><article><p>{long}</p></article></div>": "",
    }
    for html, text in cases.items():
        assert html_text.main_text(html) == text, html


def test_html_passes_decide_without_an_article():
    """Pages without a marked main part: length, stop words and links decide, short blocks inherit."""
    long = "This is the story of a man and of the sea that was all of his life and it is as long as it has to be. " * 3
    links = "".join(f"<li><a href=x>Link number {k}</a></li>" for k in range(8))
    middle = "The man was at the sea and it was all that he had in his life of work."
    page = (f"<div><ul>{links}</ul></div><div><h2>Title</h2><p>{long}</p><p>Short one.</p><p>{middle}</p><p>{long}</p></div>"
            f"<div><p>Share it</p><ul>{links}</ul><p>Read this</p><ul>{links}</ul></div><p>© 2024</p>")
    assert html_text.main_text(page) == f"Title {long.strip()} Short one. {middle} {long.strip()}"
    labels, keep = html_text.passes(*html_text.blocks_of(page))
    first = [k == (x == "good") for x, k in zip(labels, keep) if x in ("good", "bad")]
    second = [k for x, k in zip(labels, keep) if x in ("near", "short")]
    assert all(first) and len(first) == 2 + 24 and second.count(True) == 3 and second.count(False) == 3
    # inside an article: a short block goes between link lists only, an advert is no neighbour
    article = (f"<article><p>{long}</p><p>Note.</p><ul>{links}</ul><p>See also</p><ul>{links}</ul><p>After.</p>"
               f"<div class=ad>Buy</div><p>Then.</p><div class=ad>Buy</div><p>End.</p></article>")
    assert html_text.main_text(article) == f"{long.strip()} Note. After. Then. End."


def test_html_text_of_wrappers_and_many_tags(spark):
    import time

    long = "This is the story of a man and of the sea that was all of his life and it is as long as it has to be. " * 3
    page = f"<div class='shareholder-notice'><p>{long}</p><p>{long}</p></div><div id=comments><p>{long}</p></div>"
    assert html_text.main_text(page) == f"{long.strip()} {long.strip()}"
    both = f"<div class=notice><p>{long}</p></div><div><p>{long}</p></div>"
    assert html_text.main_text(both) == long.strip()
    assert html_text.main_text(f"<div class='comment notice'><p>{long}</p></div>") == ""
    began = time.perf_counter()
    html_text.main_text("<div>" * 64_000 + "</p>" * 64_000 + f"<p>{long}")
    assert time.perf_counter() - began < 10  # a scan of the open tags for each would take minutes
    huge = " ".join([long] * 3000)
    assert html_text.main_text(f"<article><p>{huge}</p></article>") == " ".join(huge.split())
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert html_text.extract(empty).count() == 0


def test_warc_null_and_text_ids(spark, tmp_path):
    pages = [("a\nb", "same"), ("c d>", "same"), ("é%2F", "other"), (None, "none"), (None, "none"), ("z", "x" * 300_000)]
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id string, url string, html string")
    folder = str(tmp_path / "w")
    warc.write_archives(df, folder)
    report = warc.page_report(warc.read_archives(spark, folder), df.schema["page_id"].dataType)
    got = sorted(((r.page_id or "", r.payload_bytes, r.record_type, r.refers_to) for r in report.collect()))
    assert got == [("", 4, "response", None), ("", 4, "revisit", None), ("a\nb", 4, "revisit", "c d>"),
                   ("c d>", 4, "response", None), ("z", 300_000, "response", None), ("é%2F", 5, "response", None)]


def test_shared_passages_make_no_pairs(spark):
    phrase = " ".join(f"phrase{k}" for k in range(12))
    docs = spark.createDataFrame([(i, prose(i, 30) + " " + phrase + " " + prose(900 + i, 30)) for i in range(60)],
                                 "doc_id long, text string")
    own = [" ".join(f"item{i}of{k}" for k in range(15)) for i in range(40)]
    items = spark.createDataFrame([(str(i), f"{t} {phrase}") for i, t in enumerate(own)], "item_id string, text string")
    found, windows = decontaminate.find_hits(docs, items)
    assert found.count() == 60 * 3 and windows.count() <= 40 * 27
    got = decontaminate.contamination(docs, items).collect()
    assert {(r.n_hit, len(r["items"])) for r in got} == {(12, 40)} and len(got) == 60


def test_lm_score(docs, empty, texts):
    training = id_bucket("doc_id", 10) != 0
    got = lm_score.score(docs, training, head=20).collect()
    assert len(got) == len(texts) + 1
    rows = [*texts, texts[1]]
    learn = [t or "" for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    c = Counter(w for t in learn for w in t.encode().lower().split())
    total, distinct = sum(c.values()) + len(learn), len(c) + 1
    norm = math.log10(total + 0.1 * (distinct + 1))
    text = dict(texts)
    for r in got:
        w = (text[r.doc_id] or "").encode().lower().split()
        base = sum(math.log10(c[x] + 0.1) for x in w) + math.log10(len(learn) + 0.1) - (len(w) + 1) * norm
        assert r.base_score == pytest.approx(base)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w) + 1, 1 + sum(c[x] > 0 for x in w), total)
        assert r.score < 0 and math.isfinite(r.score)
    assert lm_score.score(empty, training).count() == 0


def trained_on(spark, monkeypatch, texts, trainer):
    """The trained model, the start model, and per round of training its passes and the texts of each trainer."""
    rounds, whole = [], lm_score._trained

    def seen(dealt, model, lex, passes):
        rounds.append((passes, Counter(r.trainer for r in dealt.select("trainer").collect())))
        return whole(dealt, model, lex, passes)

    monkeypatch.setattr(lm_score, "_trained", seen)
    df = spark.createDataFrame([(t,) for t in texts], "_text string")
    lex = lm_score.lexicon(lm_score.word_counts(df), len(texts))
    start = lm_score.Gru.start(lex.known_counts, lex.rare[:, 0])
    return lm_score.train(df, spark.sparkContext.broadcast(lex), trainer=trainer), start, rounds


def test_lm_trains_on_all_texts(spark, monkeypatch):
    _, _, rounds = trained_on(spark, monkeypatch, [prose(i, 20) for i in range(40)], 10)
    assert sum(rounds[-1][1].values()) == 40
    for i in range(3):  # one text is enough
        model, start, _ = trained_on(spark, monkeypatch, [prose(i, 20)], 10)
        assert not np.array_equal(model.packed(), start.packed())


def test_lm_model_size(spark, monkeypatch):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(2000)),)], "_text string")
    lex = lm_score.lexicon(lm_score.word_counts(df), 1)
    assert lex.known == 1501 and len(lex.rare) == 32
    model, _, rounds = trained_on(spark, monkeypatch, [prose(i, 20) for i in range(40)], 10)
    assert model.inner.shape == (32, 96)
    assert rounds[-1][0] == 2


def test_lm_spreads_copies(spark, monkeypatch):
    texts = [prose(0, 20)] * 200 + [""] * 100 + [prose(i, 20) for i in range(300)]
    _, _, rounds = trained_on(spark, monkeypatch, texts, 100)
    dealt = rounds[-1][1]
    assert sum(dealt.values()) == 600 and len(dealt) == 6 and max(dealt.values()) < 150
    for i in range(8):  # four trainers of one text each, so the first is often empty
        model, start, _ = trained_on(spark, monkeypatch, [prose(4 * i + k, 20) for k in range(4)], 1)
        assert not np.array_equal(model.packed(), start.packed())


def test_gru_gradients():
    from pitfeat.llm import gru

    r = np.random.default_rng(0)
    g = gru.Gru.start(np.arange(1, 70)[::-1].astype(float), np.array([5.0, 7.0]))
    x, y, inside = r.integers(0, 71, (5, 3)), r.integers(0, 71, (5, 3)), np.ones((5, 3), np.float32)
    h = r.normal(0, 0.3, (3, gru.STATE)).astype(np.float32)
    grads, _, _ = g._gradients(x, y, inside, h)

    def loss():
        return -g._emit(g._forward(x, h).reshape(-1, gru.STATE), y.ravel()).mean()

    for p, d in zip(g.parameters(), grads):
        k = np.unravel_index(np.abs(d).argmax(), p.shape)
        old = p[k]
        p[k] = old + 0.01
        up = loss()
        p[k] = old - 0.01
        down = loss()
        p[k] = old
        assert d[k] == pytest.approx((up - down) / 0.02, rel=0.05)


def test_sample_is_bounded_by_rows(spark):
    from pitfeat.llm.text_classes import class_counts, share_of_class

    rows = [(None if i % 2 else i, f"t{i}", "en") for i in range(4000)]
    rows += [(7, "same", "de")] * 1000 + [(-i, f"u{i}", "fr") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, t string, l string")
    got = share_of_class(df, "k", "l", 100).collect()
    assert Counter(r.l for r in got) == {"en": 100, "de": 100, "fr": 60}
    assert 25 < sum(r.k is None for r in got) < 75
    many = spark.createDataFrame([(i, "t", f"l{i % 600}") for i in range(1200)], "k long, t string, l string")
    assert len({r.l for r in share_of_class(many, "k", "l", 1).collect()}) == 600
    assert len(class_counts(many, "l")) == 600


def test_quality_sample_of_a_repeated_id(spark):
    """Rows, not labels, bound the sample: one labelled id may be that of very many rows."""
    df = spark.createDataFrame([(7, f"t{i}") for i in range(20_000)] + [(i, "x") for i in range(20, 50)], "doc_id long, text string")
    marks = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(20, 50)], "_k long, _y int")
    got = Counter(r._y for r in quality_net.labelled_rows(df, marks, "doc_id", "text", 10).collect())
    assert got == {1: 10, 0: 10}


def test_most_frequent(spark):
    from pitfeat.llm.common import most_frequent

    rows = [(f"w{i}", c) for i, c in enumerate([1] * 50 + [2] * 9 + [3] * 5 + [6, 7, 40, 1000])]
    df = spark.createDataFrame(rows, "w string, c long")
    for most, want in ((100, 68), (68, 68), (67, 18), (18, 18), (17, 9), (9, 9), (8, 4), (3, 3), (1, 1), (0, 0)):
        got = sorted(r.c for r in most_frequent(df, "c", most).collect())
        assert len(got) == want and got == sorted(c for _, c in rows)[68 - want:]
    assert most_frequent(df.limit(0), "c", 5).count() == 0


def test_letters(spark):
    df = spark.createDataFrame([(1, "½ ② 12"), (2, "①²³"), (3, "ß"), (4, "漢")], "doc_id long, text string")
    model = language_id.train(spark.createDataFrame([(1, "a b c", "en"), (2, "x y", "de")], "doc_id long, text string, lang string"))
    got = {r.doc_id: r.lang_pred == "und" for r in language_id.identify(df, model).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False}
    assert [r.doc_id for r in language_id.identify(df, model, least=0.0).orderBy("doc_id").collect()] == [3, 4]


def test_language_and_quality(spark, empty):
    r = random.Random(2)
    en, de = "the and of that with this from have".split(), "der und das nicht mit eine von haben".split()
    rows = [(i, " ".join(r.choice(en if i % 2 else de) for _ in range(30)) + (" ### $$$" * 10 if i % 3 == 0 else ""),
             "en" if i % 2 else "de") for i in range(160)]
    df = spark.createDataFrame([*rows, (900, None, "en"), (901, "12 34 !?", None), (902, "", "de"), rows[0]],
                               "doc_id long, text string, lang string")
    model = language_id.train(df.where("doc_id < 100 or doc_id >= 900"))
    got = {x.doc_id: x for x in language_id.identify(df, model, keep=["doc_id"]).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows[100:]) >= 57
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _, _ in rows[:100]], "doc_id long, quality int")
    net = quality_net.train(df, labels)
    scored = {x.doc_id: x for x in quality_net.score(df, net, keep=["doc_id"]).collect()}
    assert sum(scored[i].predicted == int(i % 3 > 0) for i, _, _ in rows[100:]) >= 57
    assert all(0 <= x.score <= 1 for x in scored.values())
    none = language_id.train(empty)
    assert {x.lang_pred for x in language_id.identify(df, none, keep=["doc_id"]).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0
    assert {x.score for x in quality_net.score(df, quality_net.train(df, labels.limit(0)), keep=["doc_id"]).collect()} == {0.5}


def test_word_counts_are_let_go():
    """A task never holds more words than its bound, and the sums stay whole."""
    from collections import Counter

    import pyarrow as pa

    from pitfeat.llm import lm_score

    texts = [f"w{i % 40} W{i % 9} x" for i in range(200)]
    batches = [pa.RecordBatch.from_pydict({"_text": texts[i:i + 90]}) for i in range(0, 200, 90)]
    got, sizes = Counter(), []
    for b in lm_score._count_words(iter(batches), most=10):
        sizes.append(b.num_rows)
        got.update(dict(zip(b["word"].to_pylist(), b["c"].to_pylist())))
    assert max(sizes) <= 12  # the bound and the words of one text more
    assert got == Counter(w for t in texts for w in lm_score.tokens(t))
