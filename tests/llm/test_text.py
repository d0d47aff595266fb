"""Tokens, chats, pages and the classifier: round trips, plain counterparts and held-out accuracy."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from conftest import SF

pytest.importorskip("tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from vesselrisk.llm import chat, classifier, html, tokens  # noqa: E402
from vesselrisk.llm.queries import QUERIES, tokenizer_path  # noqa: E402


def tokenizer(control_as_text):
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = control_as_text
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def plain():
    """As the library encodes by default: control strings in a text are control tokens."""
    return tokenizer(False)


@pytest.mark.parametrize("control_as_text", [False, True])
def test_encoder_equals_the_tokenizer(control_as_text):
    rng = random.Random(1)
    plain = tokenizer(control_as_text)
    enc = tokens.encoder(tokenizer_path(), control_as_text)
    assert (50256 in enc.encode(["a <|endoftext|> b"])[0]) != control_as_text
    parts = ["a", "b", " ", " ", "\n", "'", "s", ".", ",", "é", "1", " ", "日", "́", "#", "<|endoftext|>", "THE!!", "word"]
    for _ in range(600):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(3)]
        ids, sizes = enc.encode(texts)
        want = [plain(t) for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_a_full_cache_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20)
    enc = tokens.Encoder(tokenizer_path())
    for k in range(5):
        texts = [" ".join(f"w{chr(97 + j)}{k}x common word" for j in range(12))]
        assert enc.encode(texts)[0].tolist() == plain(texts[0])


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(2)
    for seq in (np.full(5000, 3), np.tile([1, 2, 3, 1, 2], 900), rng.integers(0, 6, 20_000), rng.integers(0, 50_000, 300), np.array([7]), np.empty(0)):
        seq = seq.astype(np.uint32)
        rules, packed = tokens.repair(seq)
        assert np.array_equal(tokens.decode(rules, packed), seq)
        lengths = tokens.expansions(rules)[1]
        for _ in range(20):
            a, b = sorted(rng.integers(0, len(seq) + 1, 2).tolist())
            assert np.array_equal(tokens.decode_range(rules, lengths, packed, a, b), seq[a:b])
    assert len(tokens.repair(np.tile([1, 2, 3, 4], 4000).astype(np.uint32))[1]) < 4000


def _twice(seq):
    """Pairs that occur twice or more without overlap."""
    ends, count = {}, {}
    for i, pair in enumerate(zip(seq.tolist(), seq[1:].tolist())):
        if ends.get(pair, -1) < i:
            ends[pair], count[pair] = i + 1, count.get(pair, 0) + 1
    return {pair for pair, n in count.items() if n > 1}


def test_grammar_ends_when_no_pair_occurs_twice():
    rng = np.random.default_rng(4)
    run = rng.integers(0, 50_000, 9000)  # a long copy: more pairs than a round took, and more rounds than four
    few = [np.concatenate([np.tile([i, i + 1], i) for i in range(1, 60)]), np.repeat(rng.integers(0, 9, 900), rng.integers(1, 9, 900))]
    for seq in (np.tile(run, 2), rng.integers(0, 3, 20_000), rng.integers(0, 400, 20_000), np.tile([1, 2, 3, 1, 2], 900), *few):
        rules, packed = tokens.repair(seq.astype(np.uint32))
        assert np.array_equal(tokens.decode(rules, packed), seq) and not _twice(packed)
        assert len(set(map(tuple, rules.tolist()))) == len(rules)  # a pair has one rule
        assert np.array_equal(tokens.rule_lengths(rules), tokens.expansions(rules)[1])
    assert len(tokens.repair(np.tile(run, 2).astype(np.uint32))[1]) == 2


@pytest.mark.parametrize("small", [False, True])
def test_tokens_read_back(spark, odd, plain, monkeypatch, small):
    if small:
        monkeypatch.setattr(tokens, "PART_BYTES", 2000)
    rows = odd.select("doc_id", "text").collect()
    got = tokens.read_tokens(spark, tokens.write_tokens(odd, tokenizer_path())).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    place, want = 0, {}
    for r in rows:
        own = np.array(plain(r.text or "") + [0], "<u4")
        want.setdefault(r.doc_id, []).append((len(own), zlib.crc32(own.tobytes())))
    for r in got:
        assert r.start == place and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        place += r.n_tokens
    assert len(got) == len(rows)


def test_tokens_of_nothing(spark, none):
    assert tokens.read_tokens(spark, tokens.write_tokens(none, tokenizer_path())).count() == 0


def test_escape_is_reversible():
    rng = random.Random(3)
    parts = ["<", "\\", "s>", "/", "[", "INST]", "]", "|", "end", "|>", "SYS>>", "x", "<s>", "</s>", "<|end|>", "[/INST]", "é"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        e = chat.escape(t)
        assert chat.unescape(e) == t
        assert not any(x in e for x in ("<s>", "</s>", "[INST]", "[/INST]", "<|end|>", "<SYS>>"))


def test_chats_read_back(spark):
    rows = [(1, 0, "user", "</s> hi"), (1, 1, "assistant", "<|end|> yes \\"), (1, 2, "assistant", None), (2, None, None, "x"), (None, 1, "tool<|sep|>", "é"), (None, 1, "tool<|sep|>", "é"), (3, 5, "assistant", "word " * 20_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_chats(spark, chat.write_chats(turns, tokenizer_path()), tokenizer_path()).collect()}
    assert set(got) == {1, 2, 3, None}
    for c, r in got.items():
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        learned = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    none = turns.where("false")
    assert chat.read_chats(spark, chat.write_chats(none, tokenizer_path()), tokenizer_path()).count() == 0


PAGE = (
    "<html><head><title>t</title><style>p{}</style><script>x='</p>'</script></head><body><nav><a>Menu</a></nav><div class='cookie-notice'>ok?</div>{}"
    "<aside>side</aside><form><p>mail</p></form><footer>&copy; h</footer></body></html>"
)


def test_article_blocks():
    body = "<article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>\n line<br>next<p>Two<!-- c --><div class=share>Tweet</div><section id='comments'><p>First!</p></section></article>"
    assert html._article(PAGE.replace("{}", body)) == "Title & more\nOne bold line next\nTwo"
    assert html._article("<main><p>1 < 2</main>") == "1 < 2"
    assert html._article(PAGE.replace("{}", "<p>open</p>")) is None


def test_pages_without_an_article_lose_what_their_host_repeats(spark):
    menu, foot = "<p>Home News Sport Weather Contact About Imprint</p>", "<div>All content of this site belongs to its many writers.</div>"
    text = [f"Story number {i} tells of river {i} and hill {i}." for i in range(6)]
    pages = [(i, f"http://h{i % 2}.net/{i}", f"{menu}<p>{text[i]}</p>{foot}") for i in range(6)]
    pages += [(10, "http://h0.net/a", f"<nav>{menu}</nav><article>{text[0]}</article>"), (11, None, None), (12, "http://x.net", ""), (13, "http://y.net", f"{menu}<p>alone</p>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in html.extract(frame).collect()}
    assert all(got[i].text == text[i] for i in range(1, 6)) and got[10].text == text[0]
    assert (got[11].text, got[12].text, got[11].n_chars) == ("", "", 0)
    assert got[13].text == "Home News Sport Weather Contact About Imprint\nalone"
    assert html.extract(frame.where("false")).count() == 0


def test_open_pages_keep_near_copies_and_quoted_sentences(spark):
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    menu = "Home News Sport Weather Contact About Imprint"
    quote = "we shall not forget what was said here today by all of them"
    pages, want = [], {}

    def add(url, blocks, kept):
        want[len(pages)] = "\n".join(kept)
        pages.append((len(pages), url, "".join(f"<p>{b}</p>" for b in blocks)))

    for host, copies in (("two", 2), ("four", 4)):  # views of one article, an advert differs
        article = [words(60), words(50), words(8)]
        for i in range(copies):
            own = [*article, words(6)]
            add(f"http://{host}.net/a?ref={i}", own, own)
    frame = [words(40)]
    for i in range(8):  # a host with a menu, two near copies among others, and a sentence that some quote
        own = frame if i < 2 else [f"{words(20)} {quote} {words(20)}" if i < 5 else words(40), f"{words(5)} once upon a time there was {words(5)}"]
        add(f"http://mixed.net/{i}", [menu, *own, f"<!-- {i} -->"], own)
    for url in (None, "/a/b", "c.html", "?x"):  # no host
        own = [menu, words(30)]
        add(url, own, own)
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == want


def test_marks_inside_an_article_need_their_host():
    body = "<article><p class='social-history'>Social history.</p><p>He <span class='notice-of-death'>died</span> then.</p><div class='social-share'>Tweet</div><p class='reader-comments'>No!</p></article>"
    assert html._article_blocks(body) == [("weak", "Social history."), ("main", "He"), ("weak", "died"), ("main", "then.")]
    assert html._article(body) == "Social history.\nHe\ndied\nthen."


def test_articles_lose_the_blocks_that_their_host_repeats_at_an_edge_or_marked(spark):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(n))
    menu, quote, foot = "Home News Sport", words(30), words(20)
    pages, want = [], {}

    def add(url, blocks, kept):
        want[len(pages)] = "\n".join(kept)
        pages.append((len(pages), url, "<nav>x</nav><main>" + "".join(f"<div {m}>{b}</div>" for m, b in blocks) + "</main>"))

    for i in range(6):  # the menu and the foot lie at an edge, the marked block is weak, the quotation stands between own blocks
        own = [words(9), words(12)]
        blocks = [("", menu), ("", own[0]), ("", quote), ("class='alert-level-story'", "Level four of five"), ("", own[1]), ("", foot)]
        add(f"https://Big.net/{i}", blocks, [own[0], quote, own[1]])
        add(None, blocks, [b for _, b in blocks])
    for i in range(2):  # too few pages
        add(f"https://two.net/{i}", [("", menu), ("", f"{i} x")], [menu, f"{i} x"])
    text = [words(15) for _ in range(5)]
    for i in range(5):  # near copies keep all
        add(f"https://copies.net/{i}", [("", t) for t in [*text, f"v{i}"]], [*text, f"v{i}"])
    for i in range(5):  # equal articles are one page
        add(f"https://same.net/?ref={i}", [("", menu), ("", text[0])], [menu, text[0]])
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for few in (html.FEW_BLOCKS, 0):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(html, "FEW_BLOCKS", few)
            assert {r.page_id: r.text for r in html.extract(frame.repartition(5)).collect()} == want


def test_repeated_blocks_equal_a_plain_search(spark):
    """Blocks drawn from a small stock against counts over all pages of the host."""
    rng = random.Random(6)
    stock = [f"stock {i} " + "w " * rng.randrange(20) for i in range(6)]
    pages = []
    for i in range(60):
        blocks = [rng.choice(stock), *(f"own {i} {k} " + "text " * 9 for k in range(2)), rng.choice(stock)]
        pages.append((i, f"http://h{i % 4}.net/{i}", [" ".join(b.split()) for b in blocks]))
    frame = spark.createDataFrame([(i, u, "<article><p>" + "<p>".join(b) + "</article>") for i, u, b in pages], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(frame).collect()}
    for i, url, blocks in pages:
        host = [b for k, _, b in pages if k % 4 == i % 4]
        on = {b: sum(b in other for other in host) for b in blocks}
        shared = [on[b] >= html.MIN_PAGES and on[b] * html.SHARE >= len(host) for b in blocks]
        assert got[i] == "\n".join(b for b, s in zip(blocks, shared) if not s)


def test_runs_within_blocks_equal_a_plain_search(spark):
    """repeats that begin within a block of an article, against all windows of all pages of the host."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    stock = [" ".join(word() for _ in range(n)) for n in (14, 20, 9, 16)]
    pages = []
    for i in range(48):
        own = [[word() for _ in range(rng.randrange(10, 30))] for _ in range(3)]
        if rng.random() < 0.8:
            own[0] = stock[0].split() + own[0]  # begins the article
        if rng.random() < 0.8:
            own[-1] += stock[1].split()  # ends it
        if rng.random() < 0.8:
            own[1] += stock[rng.randrange(2, 4)].split()  # between own words: stays, but in a marked block
        if rng.random() < 0.3:
            own.append(stock[1].split())
        pages.append((i, f"http://h{i % 3}.net/{i}", [" ".join(b) for b in own], i % 2 == 0))
    frame = spark.createDataFrame(
        [(i, u, "<article>" + "".join(f"<p{' class=notice-of-death' if weak and k == 1 else ''}>{b}</p>" for k, b in enumerate(bs)) + "</article>")
         for i, u, bs, weak in pages], "page_id long, url string, html string")
    cut = 0
    want = {}
    for i, _, blocks, weak in pages:
        host = [b for k, _, b, _ in pages if k % 3 == i % 3]
        enough = lambda n: n >= html.MIN_PAGES and n * html.SHARE >= len(host)
        text = [f" {' | '.join(b)} " for b in host]
        whole = [enough(sum(b in other for other in host)) for b in blocks]
        runs = []
        for b in blocks:
            tokens = b.split()
            gone = set()
            for at in range(len(tokens) - html.RUN + 1):
                if enough(sum(f" {' '.join(tokens[at : at + html.RUN])} " in t for t in text)):
                    gone.update(range(at, at + html.RUN))
            runs.append([(x, y) for x in gone if x - 1 not in gone for y in [next(y for y in range(x, len(tokens) + 1) if y not in gone)] if y - x >= html.LONG])
        whole = [w or r == [(0, len(b.split()))] for w, r, b in zip(whole, runs, blocks)]
        first, last = whole.index(False), len(whole) - 1 - whole[::-1].index(False)
        out = []
        for k, b in enumerate(blocks):
            marked = weak and k == 1
            if whole[k]:
                out.append(b if first < k < last and not marked else "")
                continue
            tokens = b.split()
            for x, y in sorted(runs[k], reverse=True):
                if marked or (x == 0 and k == first) or (y == len(tokens) and k == last):
                    del tokens[x:y]
                    cut += 1
            out.append(" ".join(tokens))
        want[i] = "\n".join(t for t in out if t)
        assert html.OWN * len(want[i].split()) >= sum(len(b.split()) for b in blocks)
    assert cut > 60
    for few, buffer in ((html.FEW_BLOCKS, html.BUFFER), (0, 100)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(html, "FEW_BLOCKS", few)
            m.setattr(html, "BUFFER", buffer)
            assert {r.page_id: r.text for r in html.extract(frame.repartition(3)).collect()} == want


def test_pages_with_clashing_columns(spark):
    names = ["uid", "vr_uid", "vr_host", "covers", "host", "key", "row", "blocks", "page", "TEXT", "page_id", "odd.name`s"]
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names) + ", url string, html string"
    rows = [(*(f"{c}{i}" for c in names), "http://a.net", h) for i, h in enumerate(["<p>open</p>", "<main>shut</main>", None])]
    frame = spark.createDataFrame([r for r in rows], schema.replace("`odd.name``s`", "`odd.name`"))
    got = html.extract(frame)
    assert got.columns == [c for c in frame.columns if c not in ("TEXT", "html")] + ["text", "n_chars"]
    assert {(r.uid, r.covers, r.text, r.n_chars) for r in got.collect()} == {("uid0", "covers0", "open", 4), ("uid1", "covers1", "shut", 4), ("uid2", "covers2", "", 0)}


@pytest.mark.parametrize("part", [
    "<a ", "<a b=\"x' ", "<x \">\" ", "<!--", "<script>", "<", "<p a=\"", "</b>x", "<li><article><div></li>", "&#",
])
def test_malformed_pages_take_linear_time(part):
    started = time.time()
    html.blocks_of("<div>" * 20_000 + part * (1_000_000 // len(part)))
    assert time.time() - started < 15


def test_tags_with_open_quotes():
    assert html._article("<main><a title=\"1 > 0\">x</a> <b c='>y</b></main>") == "x y"
    assert html._article("<main>a <b 2 < 3</main>") == "a"
    assert html._article("<main>a < b <c") == "a < b <c"


def test_classifier_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, SF.replace("0.001", "0.01")).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").collect()]
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    out = [(got[d].predicted == q) for d, q in labels if got[d].held_out]
    assert len(out) > 50 and np.mean(out) > 0.95


def test_classifier_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (7, 0), (4, None), (99, 1)], "doc_id long, quality int")
    model = classifier.train(odd, labels)
    assert classifier.score(odd, model, keep=["doc_id"]).count() == odd.count()
    assert classifier.score(none, model).count() == 0
    flat = classifier.train(odd, labels.where("false"))
    assert {r.score for r in classifier.score(odd, flat).collect()} == {0.5}


def test_a_repeated_id_does_not_fill_the_training_set(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    hot = [(ids[0], "one word " * (2 + n % 150)) for n in range(600)]
    docs = [*hot, *((i, f"text {i} " * (3 + i)) for i in ids[1:])]
    seen = []
    monkeypatch.setattr(classifier, "fit", lambda x, y, w=None: seen.append((x, y, w)))
    for rows in (docs, docs[::-1]):
        classifier.train(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), labels, max_rows=len(ids))
    (x, y, w), again = seen
    assert all(np.array_equal(a, b) for a, b in zip((x, y, w), again))
    assert len(y) == 2 * len(ids) and y.sum() == len(ids) // 2  # every other id is there, the hot one fills what is left


def test_weights_are_repetitions():
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(120, len(classifier.FEATURES))), rng.integers(1, 5, 120)
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    a, b = classifier.fit(x, y, w.astype(float)), classifier.fit(np.repeat(x, w, axis=0), np.repeat(y, w))
    assert np.allclose(a.score(x), b.score(x), atol=1e-6)


def test_new_words_are_encoded_many_a_call():
    """Words of letters, punctuation and a line feed go to the model in groups, with the ids of the whole tokenizer."""
    enc = tokens.Encoder(tokenizer_path())
    assert enc.apart

    class Counted:
        calls = 0

        def tokenize(self, text, model=enc.model):
            Counted.calls += 1
            return model.tokenize(text)

    enc.model = Counted()
    odd = ["stra\u00dfe.\nNeu,", "\u00e0\u00a0x", "it's", "a\u0301b", "x1", "--", "a-b", "b.\n\nc", "\u65e5\u672c", "\u0131\u024f!?", "\u00c3\u00a0", "\xa0", "e\u0130;"]
    words = [f"{'aeiou'[i % 5]}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'.,;!'[i % 4] * (i % 3)}" for i in range(600)] + odd
    texts = ["First " + " ".join(words[i:] + words[:i]) for i in range(0, len(words), 97)]
    for _ in range(2):
        ids, lengths = enc.encode(texts)
        want = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert 0 < Counted.calls < 60
