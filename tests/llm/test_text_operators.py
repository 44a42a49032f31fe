"""Operators that look at each text by itself, against plain versions."""

import array
import hashlib
import html
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidegauge.llm import bytebpe, htmltext, langid, packing, surrogate, unigram

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "don't I'LL", "a1b22 ½²³", "<|endoftext|>x", "Ünïcode…", "ÿÿ", "'' 's", "\xa0a\x85b", "İstanbul Σας", "_a_b", "日本語 テキスト", "ab\xadc", "\x00a\x01", "ﬁne", "a\x1cb", "é", "🙂🙂", "x" * 3000]
SCHEMA = "doc_id long, text string, lang string, digest string, id int"


def texts(seed: int, n: int, alphabet: list[str], longest: int = 60) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) * rng.choice([1, 1, 1, 5]) for _ in range(rng.randrange(longest))) for _ in range(n)]


MIXED = ["a", "B", " ", "  ", "\n", "'s", "'re", "1", "½", "é", "!", "…", "日", "\xa0", "\t", "\x1c", "ß", "'", " ", "٣"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "en", "x", 1) for i, t in enumerate(ODD)] + [(None, "null id", None, None, None), (99, None, "en", None, 2), (5, ODD[5], "en", "x", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- words and packing -----------------------------------------------------------------------


def test_word_encoder_equals_the_tokenizer():
    encoder = packing.WordEncoder(WORDS)
    every = ODD + texts(1, 400, MIXED)
    assert encoder.encode(every) == [encoder.whole(t) for t in every]


def test_each_token_is_reached_by_its_own_merges():
    """What makes merging by rank equal to merging by the list of merges."""
    encoder = packing.WordEncoder(WORDS)
    known = set(encoder.ids)
    rank = {t: i for i, t in enumerate(known)}
    assert len(rank) == len(known)
    vocabulary = [t for t in encoder.tokenizer.get_vocab() if t.endswith("</w>") and t.removesuffix("</w>").isascii() and t.removesuffix("</w>").isalpha()]
    words = [t.removesuffix("</w>") for t in vocabulary if t.removesuffix("</w>") == t.removesuffix("</w>").lower()]
    sample = random.Random(0).sample(words, 3000)
    assert all(len(encoder.word(w)) == 4 and encoder.word(w) == encoder.whole(w) for w in sample)


def test_pack(spark, table):
    size = 64
    rows = packing.pack_documents(table, WORDS, size=size, open_bins=4).collect()
    encoder = packing.WordEncoder(WORDS)
    source = [(r.doc_id, encoder.whole(r.text or "") + np.array([1], "<u4").tobytes()) for r in table.collect()]
    pieces = sorted((d if d is not None else -1, i, s, n, zlib.crc32(c[4 * s : 4 * (s + n)])) for d, c in source for i, s, n in packing.cut(len(c) // 4, size))
    assert pieces == sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    assert packing.pack_documents(empty(spark), WORDS).count() == 0


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    packer = packing.BestFit(10, 2)
    assert [packer.place(n) for n in (6, 7, 3, 4, 10)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    packer = packing.BestFit(10, 2)
    for n in (9, 8, 7):  # three bins, two may be open: the one with 9 closes
        packer.place(n)
    assert packer.place(1) == (1, 8) and packer.place(3) == (2, 7)
    rng, packer, used = random.Random(3), packing.BestFit(4096, 64), {}
    lengths = [min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(5000)]
    for n in lengths:
        b, at = packer.place(n)
        assert used.get(b, 0) == at
        used[b] = at + n
    assert max(used.values()) <= 4096 and len(used) <= 1.03 * sum(lengths) / 4096


# --- byte pairs ------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk,overlap", [(5, 2), (8, 1), (16, 8), (64, 16)])
def test_stitched_chunks_equal_the_library(chunk, overlap):
    v = bytebpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    for text in ODD + texts(3, 400, MIXED):
        expected = array.array("I", v.encoding.encode_ordinary(text)).tobytes()
        assert v.encode(text) == expected
        chunks = [(s, t, *bytebpe.split_chunk(v, s, t)) for s, t in bytebpe.chunks_of(text, chunk, overlap)]
        assert bytebpe.stitch(v, chunks) == expected, text
        assert v.decode(expected) == text.encode()


@pytest.mark.parametrize("chunk", [10, 100_000])
def test_encode_digests(spark, table, chunk):
    v = bytebpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    rows = bytebpe.encode_digests(table, RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=5).collect()

    def expected(text):
        ids = array.array("I", v.encoding.encode_ordinary(text)).tobytes()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert sorted(map(str, rows)) == sorted(f"Row(doc_id={r.doc_id}, n_tokens={n}, ids_sha256='{a}', decoded_sha256='{b}')" for r in table.collect() for n, a, b in [expected(r.text or "")])
    assert bytebpe.encode_digests(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


# --- unigram counts --------------------------------------------------------------------------


def best(word, scores, byte_score, longest):
    upto = [(0.0, 0)]
    for n in range(1, len(word) + 1):
        options = [(upto[i][0] + scores[word[i:n]], upto[i][1] - 1) for i in range(max(0, n - longest), n) if word[i:n] in scores]
        if word[n - 1] not in scores:
            k = len(word[n - 1].encode())
            options.append((upto[n - 1][0] + k * byte_score, upto[n - 1][1] - k))
        upto.append(max(options))
    return upto[-1]


def test_token_counts(spark, table):
    scores, byte_score = unigram.load_scores(PIECES)
    rows = unigram.token_counts(table, PIECES).collect()
    expected = {}
    for r in table.collect():
        found = [best("▁" + w, scores, byte_score, max(map(len, scores))) for w in unigram.PRE_TOKEN.findall(r.text or "")]
        expected.setdefault(r.doc_id, []).append((sum(-n for _, n in found), len(found), sum(s for s, _ in found)))
    for r in rows:
        assert any((r.n_tokens, r.n_pretokens) == e[:2] and math.isclose(r.score, e[2], abs_tol=1e-6) for e in expected[r.doc_id])
    assert len(rows) == table.count() and unigram.token_counts(empty(spark), PIECES).count() == 0


def test_the_trie_and_the_single_path_agree():
    scores, byte_score = unigram.load_scores(PIECES)
    pieces = unigram.vocabulary_trie(scores)
    words = ["▁" + "".join(random.Random(i).choice("aeioutrnslé日") for _ in range(i % 90)) for i in range(300)]
    assert unigram.Trie(words).counts(pieces, byte_score) == {w: unigram.long_count(w, pieces, byte_score) for w in words}


# --- long texts ------------------------------------------------------------------------------


LONG = {"words": "words of Content and 12 more, " * 340_000, "run": "x" * 3_000_000, "marks": "<p>" * 1_000_000}


@pytest.mark.parametrize("kind", LONG)
def test_long_texts(kind):
    """Ten million characters in time that grows with them, and memory that doesn't explode."""
    text = LONG[kind]
    pieces, byte_score, _ = unigram.vocabulary_of(PIECES)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    (counted,) = unigram._counted([batch], pieces, byte_score, {})
    assert counted.column(2)[0].as_py() == len(text.split())
    v = bytebpe.vocabulary_of(RANKS, public_tokenizers.PATTERN)
    chunks = [(s, t, *bytebpe.split_chunk(v, s, t)) for s, t in bytebpe.chunks_of(text, bytebpe.CHUNK, bytebpe.OVERLAP)]
    assert v.decode(bytebpe.stitch(v, chunks)) == text.encode()
    model = langid.Model({"aa": (np.array([1, 2], np.uint32), np.ones(2)), "bb": (np.array([3], np.uint32), np.ones(1))})
    model.build()
    assert model.score([text.encode()]).shape == (1, 2)
    surrogate.find(text)
    assert len(htmltext.main_text(text)) <= len(text)


def test_slices_of_a_text_score_as_the_whole(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcde é日") for _ in range(n)).encode() for n in (1, 5, 3000, 20_000)]
    grams, n = np.unique(langid.grams_of(texts[:3])[0], return_counts=True)
    model = langid.Model({"aa": (grams, n.astype(float)), "bb": (grams[::2], n[::2].astype(float))})
    model.build()
    whole = model.score(texts)
    monkeypatch.setattr(langid, "CELLS", 0)
    assert np.concatenate([model.score([t]) for t in texts]) == pytest.approx(whole)


# --- languages -------------------------------------------------------------------------------


def plain_bits(counts, gram):
    """PPM by its definition, one string at a time; counts of four-byte strings."""
    excluded, bits = set(), 0.0
    for order in (3, 2, 1, 0):
        context = gram[3 - order : 3]
        after = {}
        for g, n in counts.items():
            if g[3 - order : 3] == context:
                after[g[3]] = after.get(g[3], 0) + n
        if not after:
            continue
        left = {s: n for s, n in after.items() if s not in excluded}
        total = sum(left.values()) + len(left)
        if gram[3] in left:
            return bits + math.log2(total) - math.log2(left[gram[3]])
        if left:
            bits += math.log2(total) - math.log2(len(left))
        excluded = set(after)
    return bits + math.log2(256 - len(excluded))


def test_code_lengths_are_those_of_a_probability():
    text = b"abracadabra abracad brac"
    counts = {}
    padded = bytes(3) + text
    for i in range(len(text)):
        counts[padded[i : i + 4]] = counts.get(padded[i : i + 4], 0) + 1
    keys = sorted(counts)
    tree = langid.ContextTree(np.array([int.from_bytes(k, "big") for k in keys], np.uint32), np.array([counts[k] for k in keys], float))
    for context in (b"abr", b"zbr", b"zzr", b"zzz", b"\0\0\0", b"rac"):
        every = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint32)
        bits = tree.bits(every)
        assert np.exp2(-bits).sum() == pytest.approx(1.0)
        assert bits.tolist() == pytest.approx([plain_bits(counts, context + bytes([b])) for b in range(256)])


def test_languages(spark):
    rng = random.Random(5)
    syllables = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["ster", "ung", "ich", "ver"], "cc": ["ção", "nh", "eu", "os"]}
    rows = [(i, " ".join("".join(rng.choice(s) for _ in range(3)) for _ in range(30)), lang, "", 1) for i, (lang, s) in enumerate(list(syllables.items()) * 60)]
    edge = [(1000, None, "aa", "", 1), (1001, "123 …", "aa", "", 1), (1002, "", None, "", 1), (None, "kalomi", None, "", 1), (1003, "verungich", None, "", 1)]
    got = {r.doc_id: r for r in langid.predict_languages(spark.createDataFrame(rows + edge, SCHEMA)).collect()}
    assert len(got) == len(rows) + len(edge)
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang, *_ in rows)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert [got[i].lang_pred for i in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "aa", "bb"]
    assert langid.predict_languages(empty(spark)).count() == 0
    nothing = langid.predict_languages(spark.createDataFrame([(1, "text", None, "", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


# --- pages -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="no-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a><li>About</ul></nav>
<div class="ad">Buy this now, it is a very good thing to have</div>{0}<aside>More to read</aside><div id="comments"><p>I disagree with all of this, said a reader at some length</p></div><form><label>Mail</label><input></form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize(
    "body,text",
    [
        ("<article><header><h1>A  title</h1></header><p>One &amp; two.<p><b>Th</b>ree.<br>Four<div>five</div></article>", "A title One & two. Three.Four five"),
        ("<main><p>Text</p></main>", "Text"),
        ("<div class='post'><h1>Long heading of it</h1><p>" + "words of content " * 20 + "</p><p>Short.</p><p>" + "and more of it " * 20 + "</p></div>", "Long heading of it " + ("words of content " * 20).strip() + " Short. " + ("and more of it " * 20).strip()),
        ("<article><p>&lt;tag&gt; &#8364;&nbsp;5</p><article class='comment'><p>me too</p></article></article>", "<tag> € 5"),
    ],
)
def test_main_text(body, text):
    got = htmltext.main_text(PAGE.format(body))
    assert got == text.replace("Three.Four", "Three.Four") or got == text.replace("Three.Four", "Three. Four")


@pytest.mark.parametrize(
    "page",
    [
        *(f"<html><head><title>T</title></head><body><div class='{mark}'>{{}}<div class='sidebar'>Look here</div></div><footer>us</footer></body></html>" for mark in ("has-sidebar", "content-sidebar-wrap", "no-comments", "menu-open", "share-page")),
        "<html><head></head><body><form id='aspnetForm'><div class='menu'>Home</div>{}</form></body></html>",
        "<html><head><title>T</title><body>{}<div class='ad'>Buy</div></body></html>",
        "<html><head><title>T</title><meta name='a'>{}<div class='ad'>Buy</div></html>",
        "<html><body><div class='widget'>{}<div id='comments'><p>" + "me too I say " * 90 + "</p></div></div><div class='related'><article><p>Read this</p></article></div></body></html>",
    ],
)
@pytest.mark.parametrize("part", ["article", "main", "div"])
def test_wrappers_of_a_page_shut_nothing_in(page, part):
    if part == "div" and "<article>" in page:
        pytest.skip("teasers are this page's only article")
    text = " ".join(["words of content " * 20, "and more of it " * 20, "and the end of it " * 20])
    got = htmltext.main_text(page.format(f"<{part}>" + "".join(f"<p>{x}</p>" for x in text.split("  ")) + f"</{part}>"))
    assert got == " ".join(text.split())


@pytest.mark.parametrize("opened", ["<div>", "<div class='ad'>", "<b>", "<li>", "<ul><li>", "<p>", "<table><tr><td>", "<article>", "</b><i>", "<nav><article>"])
def test_deep_pages_take_linear_time(opened):
    began = time.process_time()
    text = htmltext.main_text(opened * 20_000 + "words of content " * 20 + "<p></p><li></li></u>" * 5_000)
    assert time.process_time() - began < 3 and text in ("", ("words of content " * 20).strip())


def test_names_of_parts_of_an_article_are_no_marks():
    words = "words of content " * 20
    for name in ("related-research", "social-history", "noticeBoardOfEvents"):
        assert htmltext.main_text(f"<article><p>{words}</p><div class='{name}'>{words}</div></article>") == (words + words).strip()
    for name in ("related-links", "social-share", "share-buttons", "box newsletter"):
        assert htmltext.main_text(f"<article><p>{words}</p><div class='{name}'>{words}</div></article>") == words.strip()


def test_a_page_that_marks_nothing_ends_with_content():
    words = "words of content " * 20
    page = f"<html><body><div>Home</div><h1>Heading</h1><p>{words}</p><p>Short.</p><p>{words}</p><p>Copyright 2024 Example</p></body></html>"
    assert htmltext.main_text(page) == f"Heading {words}Short. {words}".strip()


def test_smoothing_and_threshold():
    rng = random.Random(2)
    values = [rng.random() * 6 for _ in range(40)]
    for n in (1, 2, 3, 4, 5, 40):
        own = values[:n]
        weights = [[math.exp(-((i - j) ** 2) / 2) if abs(i - j) <= htmltext.REACH else 0 for j in range(n)] for i in range(n)]
        assert htmltext.smoothed(own) == pytest.approx([sum(w * v for w, v in zip(row, own, strict=True)) / sum(row) for row in weights])
    assert htmltext.threshold([1.0, 1.2, 0.8, 5.0, 5.2, 4.8]) == pytest.approx(3.0) and htmltext.threshold([2.0]) == 2.0
    cut = htmltext.threshold(values)
    low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
    assert cut == pytest.approx((sum(low) / len(low) + sum(high) / len(high)) / 2)


def test_the_region_is_the_deepest_element_of_nearly_all_content():
    page = "<body><div><div><p>{0}</p><p>{0}</p></div><p>short</p></div><div><p>{1}</p></div></body>"
    parser = htmltext.Lines()
    parser.feed(page.format("a" * 100, "b" * 10))
    parser.line()
    held = {n: sum(len(x.text) for x in parser.lines if n in ancestors(parser.parents, x.element)) for n in range(len(parser.parents))}
    region, last = htmltext.region_of(parser.lines, parser.parents)
    assert held == {**held, **htmltext.up_the_tree({x.element: len(x.text) for x in parser.lines}, parser.parents)}
    deep = [n for n in held if held[n] >= htmltext.MOST * held[0]]
    assert region == max(deep, key=lambda n: len(ancestors(parser.parents, n))) and all((region <= n <= last) == (region in ancestors(parser.parents, n)) for n in held)


def ancestors(parents, n):
    out = []
    while n >= 0:
        out.append(n)
        n = parents[n]
    return out


def test_main_text_of_whole_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r for r in htmltext.extract_text(pages).collect()}
    for page in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|a|i)(?:\s[^>]*)?>", "", inside))).split())
        assert rows[page.page_id].text == expected and rows[page.page_id].n_chars == len(expected)


def test_pages_without_text(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 1), (None, "u", "<p>", 1), (4, "u", "<script>x</script>", 2), (4, "u", "plain &amp; text", 2), (5, "u", "<nav><p>a" * 500, 1)], "page_id long, url string, html string, text int")
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in htmltext.extract_text(pages).collect()) == [("1", "", 0), ("2", "", 0), ("4", "", 0), ("4", "plain & text", 12), ("5", "", 0), ("None", "", 0)]
    assert htmltext.extract_text(pages.limit(0)).count() == 0


# --- personal data ---------------------------------------------------------------------------

LETTER = "Dear Mr. John Smith, write to JOHN.smith@mail.example.com or John.Smith@mail.example.com, call +1 (212) 555-0147 or +1 212 555 0147, pay 4111 1111 1111 1111 to DE89 3704 0044 0532 0130 00; 10.1.2.3, 93.184.216.34, fe80::1:2:3:4, 078-05-1120, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\". Mrs Smith and Иван Петров agree. Version 4.0, 12 of 30, 2024-01-02."


def test_entities_are_found_and_replaced_in_kind():
    kinds = [k for _, _, k in surrogate.find(LETTER)]
    assert kinds == ["given", "surname", "email", "email", "phone", "phone", "number", "iban", "ipv4", "ipv4", "ipv6", "national", "secret", "surname", "given", "surname"]
    new, n = surrogate.replaced(LETTER, {}, b"k")
    assert n == 16 and len(new) == len(LETTER) + len(new) - len(LETTER)
    found = {k: [] for k in kinds}
    for a, b, k in surrogate.find(new):
        found[k].append(new[a:b])
    assert not any(LETTER[a:b] in new for a, b, _ in surrogate.find(LETTER))
    assert found["email"][0].lower() == found["email"][1].lower() and found["email"][0][:4].isupper()
    assert re.sub(r"\D", "", found["phone"][0]) == re.sub(r"\D", "", found["phone"][1]) and found["phone"][0].startswith("+1 (")
    assert surrogate.luhn_sum(found["number"][0].replace(" ", "")) == 0
    iban = found["iban"][0].replace(" ", "")
    assert iban[2:4] == surrogate.iban_check("DE", iban[4:]) and found["ipv4"][0].startswith("10.") and "Version 4.0, 12 of 30, 2024-01-02." in new
    assert new.split()[2] in surrogate.GIVEN["latin", "m"] and re.search(r"[А-Я][а-я]+ [А-Я][а-я]+ agree", new)
    assert new.split()[3].rstrip(",") == re.search(r"Mrs (\w+)", new)[1]
    assert surrogate.replaced(LETTER, {}, b"k") == (new, n) != surrogate.replaced(LETTER, {}, b"other")


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_surrogates_stay_distinct(spark, broadcast_rows):
    """So many short addresses that first surrogates collide."""
    mails = [f"{a}{b}@x.example" for a in "abcdefghijklmnopqrst" for b in "uvwxyzabc"]
    mails += [m.replace("@x", "1@x") for m in mails]
    rows = [(i, f"to {m} and {mails[i - 1]}", "en", "d", 1) for i, m in enumerate(mails)] + [(None, None, None, None, None), (-1, "", None, "row", 2), (0, f"to {mails[0]} and {mails[-1]}", "en", "d", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = surrogate.replace_entities(docs, broadcast_rows=broadcast_rows)
    assert got.columns == [*docs.columns, "n_entities"] and got.count() == len(rows)
    seen = {}
    for r in got.collect():
        if r.n_entities:
            _, a, _, b = r.text.split()
            for real, new in ((mails[r.doc_id], a), (mails[r.doc_id - 1], b)):
                assert seen.setdefault(real, new) == new
        else:
            assert not r.text
    assert len(set(seen.values())) == len(mails) and not set(seen.values()) & set(mails)
    assert surrogate.replace_entities(empty(spark)).count() == 0


def plain_attempts(texts):
    """The attempt of each entity, settled round by round in one place."""

    def form(kind, value):
        group = "name" if kind in ("given", "surname") else "digits" if kind in ("phone", "number", "national") else kind
        return group, value.lower() if group == "name" else value.replace("-", "") if group == "digits" else value

    entities = {(k, surrogate.normal(k, t[a:b])) for t in texts for a, b, k in surrogate.find(t or "")}
    reals = {}
    for k, n in entities:
        reals.setdefault(form(k, n), set()).add(k)
    attempts, taken, going = {}, set(), dict.fromkeys(entities, 0)
    while going:
        wanted = {}
        for (k, n), attempt in going.items():
            wanted.setdefault(form(k, surrogate.surrogate(k, n, attempt)), []).append((k, n))
        fresh, later = set(), {}
        for f, owners in wanted.items():
            for k, n in owners:
                real = reals.get(f, set()) - ({"given"} if k == "given" else set())
                if (k, n) != min(owners) or f in taken or (real and going[k, n] < 4 * surrogate.EASY_ATTEMPTS):
                    later[k, n] = going[k, n] + 1
                else:
                    attempts[k, n] = going[k, n]
                    fresh.add(f)
        taken |= fresh
        going = later
    return attempts


@pytest.mark.parametrize("broadcast_rows", [50_000, 0])
def test_surrogates_of_a_table(spark, broadcast_rows):
    rng = random.Random(12)
    given, parts = [n for (script, _), names in surrogate.GIVEN.items() if script == "latin" for n in names], ["ba", "ke", "lo", "mi", "nu", "ra", "st"]

    def surname():
        return "".join(rng.choice(parts) for _ in range(rng.choice([1, 2]))).capitalize()

    forms = [
        lambda: f"{rng.choice(given)} {surname()} wrote to {surname()} {surname()}.",
        lambda: f"Mr {surname()} and Ms {rng.choice(given)} came.",
        lambda: f"Call {rng.randrange(20, 60)}{rng.randrange(10)}-{rng.randrange(200, 204)}-{rng.randrange(1000, 1006)} or 4111 1111 1111 {rng.choice([1111, 1129, 1137])}.",
        lambda: f"Mail {rng.choice('ab')}{rng.choice('cd')}@x.example, 078-05-11{rng.randrange(10, 30)}.",
        lambda: "Nothing of the kind 12 times.",
    ]
    texts = [" ".join(rng.choice(forms)() for _ in range(rng.choice([1, 3]))) for _ in range(250)]
    got = {r.doc_id: r for r in surrogate.replace_entities(spark.createDataFrame([(i, t, "en", "d", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3), broadcast_rows=broadcast_rows).collect()}
    attempts = plain_attempts(texts)
    assert max(attempts.values()) > 0
    for i, text in enumerate(texts):
        assert (got[i].text, got[i].n_entities) == surrogate.replaced(text, attempts, surrogate.KEY)


@pytest.mark.parametrize(
    "text,words",
    [
        ("Mr Smith came. Later Smith said that Maria Jones left, and Maria wrote to Jones.", "Smith Smith Maria Jones Maria Jones"),
        ("Priya Raghunathan and Kwame Mensah met Ahmed Hassan", "Priya Raghunathan Kwame Mensah Ahmed Hassan"),
        ("Then Mr O'Neil came, and O’Neil's dog.", "O'Neil"),
        ("MARIA JONES wrote. Then Jones left.", "MARIA JONES Jones"),
        ("Anna-Maria Schmidt und Frau Schmidt", "Anna-Maria Schmidt Schmidt"),
        ("call 2125550147 or 0171 555 0147", "2125550147 0171|555|0147"),
        ("The Old Bridge was built. New York Times and Big Ben are old. It rained with High Winds.", ""),
        ("cards 4111111111111111, 4111-1111-1111-1111 and, of no card, 4111111111111112", "4111111111111111 4111-1111-1111-1111"),
        ("At 1372424400 the file of 2024-01-02 had 12 345 678 rows", ""),
    ],
)
def test_what_is_found(text, words):
    assert [text[a:b].replace(" ", "|") for a, b, _ in surrogate.find(text)] == words.split()
    new = surrogate.replaced(text, {}, surrogate.KEY)[0]
    assert not any(re.search(rf"(?<!\w){re.escape(w)}(?!\w)", new) for w in words.replace("|", " ").split(" ") if len(w) > 4)


@pytest.mark.parametrize("secret", ["AKIA" + "QWERTYUIOPASDFGH", "ASIA" + "QWERTYUIOPASDFGH", "ghp_" + "abcdefghij" * 3, "sk-" + "abcdefghij" * 2, "٠١٢-٣٤٥-٦٧٨٩"])
def test_entities_without_ascii_digits_or_marks(secret):
    new, n = surrogate.replaced(f"Prose before, {secret} and prose after it.", {}, surrogate.KEY)
    assert n == 1 and secret not in new and len(new) == len(f"Prose before, {secret} and prose after it.")


def test_names_are_replaced_whole_and_wherever_they_stand():
    text = "KOWALSKI came. Anna Kowalski wrote. Later Kowalski left, and Anna said no; ANNA, Kowalski's and Nowak-Kowalski too. The kowalski stays."
    new, n = surrogate.replaced(text, {}, surrogate.KEY)
    given, surname = re.search(r"came\. (\w+) (\w+) wrote", new).groups()
    assert n == 8 and new == text.replace("Anna", given).replace("ANNA", given.upper()).replace("Kowalski", surname).replace("KOWALSKI", surname.upper())
    for text, words in (
        ("Then Juan Carlos García Márquez López spoke.", ["Juan", "Carlos", "García", "Márquez", "López"]),
        ("Then Peter van der Berg spoke. Berg left.", ["Peter", "Berg", "Berg"]),
        ("Then Mr de la Cruz spoke.", ["Cruz"]),
        ("Prof. Green met Mrs Green and Dr Prof White.", ["Green", "Green", "White"]),
    ):
        assert [text[a:b] for a, b, _ in surrogate.find(text)] == words
        new = surrogate.replaced(text, {}, surrogate.KEY)[0]
        assert not any(re.search(rf"\b{w}\b", new) for w in words)
    for text in ("Dr " + "Word " * 40_000, "Anna " * 40_000, "Anna " + "van " * 40_000, "Anna B" + "b-B" * 60_000, "Anna Bo " + "Bo-" * 60_000):
        surrogate.find(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "a1" * 100_000, ("word " * 10 + "@ 1:2=3 ") * 3000):
        surrogate.find(text)
