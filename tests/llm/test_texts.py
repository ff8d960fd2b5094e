"""Page text, personal data, licenses, benchmark passages and pieces against brute force or a round trip."""

import collections
import hashlib
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.llm import decontaminate, html_text, licenses, pieces, pii

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, _spans string, _h string, n_chars long"


def named(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "xx", "clash", "clash", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


# pages

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>'
    '<nav><a href="/a">menu one</a></nav><div class="ad">buy this</div><div class="cookie-notice">we use cookies</div>'
    '<article><h1>Title &amp; more</h1><p><b>First  line.<br><p>Second &lt;line&gt;\n goes on <a href="x">here</a>.</p>'
    '<ul><li>one<li>two</ul><form><p>mail</p></form></article><div id="comments"><p>reader says</p></div>'
    '<aside>side</aside><footer>&copy; foot</footer>'
)


def test_article_of_a_page():
    assert html_text.extract(PAGE) == "Title & more\nFirst line.\nSecond <line> goes on here.\none\ntwo"
    assert html_text.extract(PAGE + "</body></html>") == html_text.extract(PAGE)


LONG = "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(4))
LONG_TEXT = "\n".join(f"{'word ' * 30}{i}" for i in range(4))


@pytest.mark.parametrize("page", [
    f"<body><form><div>{LONG}</div></form></body>",
    f"<body><nav><a href=x>home</a></nav><div class='page with-sidebar'><div>{LONG}</div><div class=sidebar>aside</div></div></body>",
    f"<body><article class='post comments-open'>{LONG}<section class='comments'><p>nice</p></section></article></body>",
    f"<body><main class='no-sidebar'>{LONG}</main><aside><article><p>teaser text</p></article></aside></body>",
    f"<body><div class=widget><div>{LONG}</div></div></body>",
    f"<body><div><x-part><x-part>{LONG}</x-part></x-part></div><div class=comments><p>{'reply ' * 300}</p></div></body>",
])
def test_names_of_elements_do_not_remove_the_article(page):
    assert html_text.extract(page) == LONG_TEXT


def test_formulas_and_objects_are_text():
    page = f"<article>{LONG}<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x</annotation></math> and <object>a b</object></p></article>"
    assert html_text.extract(page) == LONG_TEXT + "\nso x=1 and a b"


def test_densities_equal_the_formula():
    """A small tree: every density by hand, and the sum that chooses the container."""
    import math

    page = "<body><div><p>" + "a" * 60 + "</p><p>" + "b" * 30 + "<a href=x>" + "c" * 10 + "</a></p></div><div><a href=y>" + "d" * 20 + "</a></div></body>"
    root, nodes, blocks = html_text._tree(page)
    html_text._measure(root, nodes, blocks)

    def density(chars, tags, link_chars, link_tags):
        plain, share = max(chars - link_chars, 1), 30 / 120
        base = math.log(chars / plain * link_chars + share * chars + math.e)
        ratio = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
        return chars / max(tags, 1) * math.log(max(ratio, 1)) / max(math.log(max(base, math.e)), 1)

    first, second = density(60, 0, 0, 0), density(40, 1, 10, 1)
    by_hand = {"body": density(120, 6, 30, 2), "div": density(100, 3, 10, 1)}
    got = {n.tag: n for n in reversed(nodes)}
    assert {t: got[t].density for t in by_hand} == pytest.approx(by_hand)
    assert got["div"].total == pytest.approx(first + second)


@pytest.mark.parametrize("part", ["<x>", "<article>", "<b>", "<b><i>", "<p><b>", "<div class=nav>", "</b><b><div>", "<td>", "<li>", "<a href=x>"])
def test_deep_pages_take_linear_time(part):
    import time

    html_text.extract("<body>" + part * 1000)
    start = time.process_time()
    assert isinstance(html_text.extract("<body>" + part * (600_000 // len(part)) + "end>"), str)
    assert time.process_time() - start < 20



def test_article_without_article_element():
    body = "".join(f"<p>{'word ' * 40}{i}</p>" for i in range(5))
    links = "".join(f'<li><a href="/{i}">link {i}</a></li>' for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div><div class='footer'>bye</div></body>"
    assert html_text.extract(page) == "\n".join(f"{'word ' * 40}{i}" for i in range(5))


@pytest.mark.parametrize("page", [
    None, "", "<", "<p", "</p></div>", "<!-- open", "<script>x", "<a href='x>y</a>", "<div class=ad>x</div>", "&amp", "<p>\x00</p>",
    "<table><tr><td>a<td>b<tr><td>c</table>", "<b>" * 2000 + "deep", "x" * 200_000,
])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_text.extract(page), str)


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", PAGE, "a"), (1, "u", PAGE, "b"), (None, None, None, "c"), (2, "v", "", "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, html_text.extract_pages(df).collect()), key=str)
    text = html_text.extract(PAGE)
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert html_text.extract_pages(df.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_given_pages_equal_their_article(spark):
    import html

    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*)</article>", r.html).group(1)
        blocks = re.split(r"</?p>|</?h1>", article.replace("<br>", " "))
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


# personal data

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(CONTRACT.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(found)]


PRIVATE = [
    None, "", "a@b.c+d@e.f x a.b@c.d.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3", "😀 4111 1111 1111 1111 é +1 (234) 555-7777 a@b-c.d",
    "4111-1111-1111-1111-1111", "1" * 5000, "+1" * 3000, "a" * 20_000 + "@", "mail a@b.c.d..e @x.y %@-.-", "+1 234 567 890 1.2.3.4",
    "visa 4111111111111111 4111111111111112 5500 0000 0000 0004",
]


def test_spans_equal_the_contract(spark):
    got = {r.doc_id: r for r in pii.find_personal_data(named(spark, PRIVATE)).collect()}
    for i, text in enumerate(PRIVATE):
        spans = brute_spans(text)
        counts = collections.Counter(k for k, _, _ in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in CONTRACT]
        assert (r.base_sha256, r.spans) == (hashlib.sha256(joined.encode()).hexdigest(), joined)


def test_account_numbers_and_context(spark):
    texts = [
        "pay to DE89370400440532013000 now", "pay to DE88370400440532013000 now", "XK051212012345678906 xx", "iban XK051212012345678906",
        "GB82 WEST 1234 5698 7654 32", "card 4111111111111111",
    ]
    got = [r for r in pii.find_personal_data(named(spark, texts)).orderBy("doc_id").collect()]
    assert [r.spans for r in got] == ["iban:7:29", "", "", "iban:5:25", "iban:0:27", "card:5:21"]
    assert got[3].scored == "iban:5:25:0.6" and got[5].scored == "card:5:21:1.0"
    assert got[0].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_redaction(spark):
    texts = ["😀 4111 1111 1111 1111 é a@b-c.d", None, "", "clean"]
    df = named(spark, texts)
    got = pii.redact(df)
    assert got.schema == df.schema
    assert [(r.text, r.n_chars) for r in got.orderBy("doc_id").collect()] == [
        ("😀 [CARD] é [EMAIL]", 18), (None, None), ("", 0), ("clean", 5)]
    assert {r._spans for r in got.collect()} == {"clash"}
    assert pii.find_personal_data(df.limit(0)).collect() == [] == pii.redact(df.limit(0)).collect()


# licenses

LICENSED = [
    None, "", "MIT", "text before. Released under the MIT License. text after", "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!",
    "This work is licensed under the GNU General Public License, version 3. And so on", "the license of the work is general",
    "w " * 500 + licenses.TEMPLATES[13][1] + " more" * 40, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.",
    licenses.TEMPLATES[8][1].replace("redistribute", "give away"),
]


def test_license_notices(spark):
    df = named(spark, LICENSED)
    got = collections.defaultdict(set)
    for r in licenses.scan(df).collect():
        got[r.doc_id].add(r.license)
    assert got == {3: {"MIT"}, 4: {"MIT"}, 5: {"GPL-3.0"}, 7: {"MIT"}, 8: {"MIT", "CC-BY-NC-4.0"}, 9: {"GPL-3.0"}}
    assert licenses.scan(df.limit(0)).collect() == []


def test_licenses_without_literals_are_the_same(spark, monkeypatch):
    df = named(spark, LICENSED)
    first = sorted(map(tuple, licenses.scan(df).collect()))
    monkeypatch.setattr(licenses, "LITERALS", 0)
    assert sorted(map(tuple, licenses.scan(df).collect())) == first


def test_notices_of_sister_licenses_in_one_document(spark):
    """The first notice holds most of the other license's template, whose own notice comes later and is not exact."""
    third, second = licenses.TEMPLATES[6][1], "That" + licenses.TEMPLATES[7][1][4:]
    texts = [third + " word" * 60 + " " + second, second + " word" * 60 + " " + third, second, third + " word" * 60 + " " + third]
    found = collections.defaultdict(list)
    for r in licenses.scan(named(spark, texts)).collect():
        found[r.doc_id].append((r.license, r.containment, r.first_token))
    assert {i: sorted(x[:2] for x in f) for i, f in found.items()} == {
        0: [("GPL-2.0", 0.875), ("GPL-3.0", 1.0)], 1: [("GPL-2.0", 0.875), ("GPL-3.0", 1.0)],
        2: [("GPL-2.0", 0.875)], 3: [("GPL-3.0", 1.0)],
    }


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError):
        licenses.scan(named(spark, ["x"]), [("x", "too short a text")])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_licenses_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    wanted = [(name, {tuple(split(t)[i : i + 5]) for i in range(len(split(t)) - 4)}) for name, t in licenses.TEMPLATES]
    expected = set()
    for r in docs.collect():
        own = split(r.text)
        held = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        full = {name for name, s in wanted if s <= held}
        expected |= {(r.doc_id, name) for name in full}
    assert {(r.doc_id, r.license) for r in licenses.scan(docs).where("containment = 1").collect()} == expected


# benchmark passages


def brute_overlaps(docs, items):
    items = {i: decontaminate.tokens(t) for i, t in items}
    found = {}
    for doc, text in docs:
        own = decontaminate.tokens(text)
        for item, other in items.items():
            for shift in range(-len(other), len(own)):
                hit = decontaminate.overlap(own, other, shift)
                if hit and len(other) >= 6:
                    found[doc, item] = max(found.get((doc, item), (0, 0, 0)), (hit[2], -hit[0], hit[1]))
    return {(d, i, -s, n, e) for (d, i), (e, s, n) in found.items()}


def test_overlaps_equal_brute_force(spark):
    item = " ".join(f"q{i}" for i in range(30))
    def swap(*at):
        return " ".join("zz" if i in at else f"q{i}" for i in range(30))
    docs = [
        None, "", "a b c", f"before {item} after", f"x {swap(3, 11, 19, 26)} y", item.upper().replace(" ", "!! ") + "***", swap(*range(0, 30, 3)),
        " ".join(f"q{i}" for i in range(11)), " ".join(f"q{i}" for i in range(12)), " ".join(f"q{i}" for i in range(29, -1, -1)), item + " " + item,
        "short item of seven words is here", "short item of six",
    ]
    items = [(0, item), (1, "short item of seven words is here"), (2, None), (3, ""), (4, "a b c"), (5, item), (6, "is")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, seed string")
    df = named(spark, docs)
    got = set(map(tuple, decontaminate.contaminated(df, bench).collect()))
    assert got == brute_overlaps(list(enumerate(docs)), [(i, t or "") for i, t in items])
    kept = decontaminate.drop_contaminated(df.withColumn("_gone", F.lit(0)), bench)
    assert kept.columns == [*df.columns, "_gone"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 6, 7, 9, 12]
    assert decontaminate.contaminated(df.limit(0), bench).collect() == []
    assert decontaminate.contaminated(df, bench.limit(0)).collect() == []


def test_rows_without_id_are_reported(spark):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.contaminated(named(spark, [item, item, "x"], [None, 4, 4]), bench).collect()
    assert sorted((r.doc_id or -1, r.n_equal) for r in got) == [(-1, 20), (4, 20)]


def test_masks_reach_three_substitutions_of_fifteen():
    from itertools import combinations

    places = [frozenset(o + i for i, x in enumerate(m) if x == "1") for m in decontaminate.MASKS for o in range(16 - len(m))]
    assert all(any(p.isdisjoint(s) for p in places) for s in combinations(range(15), 3))


def holds(equal, least):
    """The rule itself: some stretch of at least ``least`` tokens has four fifths of them equal; the most equal tokens of such."""
    n = len(equal)
    return max((sum(equal[a:b]) for a in range(n) for b in range(a + least, n + 1) if 5 * sum(equal[a:b]) >= 4 * (b - a)), default=0)


def test_every_overlap_of_the_rule_counts():
    from itertools import combinations

    rng = np.random.default_rng(7)
    cases = [(n, at) for n, k in ((6, 1), (10, 2), (12, 2), (15, 2), (15, 3), (16, 4)) for at in combinations(range(n), k)]
    cases += [(n, tuple(np.flatnonzero(rng.random(n) < share))) for n in (12, 20, 33, 60) for share in (0.1, 0.2, 0.3) for _ in range(20)]
    cases.append((72, tuple(range(12, 72, 4))))  # 12 equal tokens, then three of four
    for n, at in cases:
        item = [f"q{i}" for i in range(n)]
        doc = ["x", *("zz" if i in at else w for i, w in enumerate(item)), "y"]
        hit = decontaminate.overlap(doc, item, 1)
        most = holds([i not in at for i in range(n)], min(12, n))
        assert (hit[2] if hit else 0) == most, (n, at)
        if hit:
            assert hit[1] >= min(12, n) and 5 * hit[2] >= 4 * hit[1]
            assert hit[2] == sum(i not in at for i in range(hit[0] - 1, hit[0] - 1 + hit[1]))


def test_seeds_reach_every_overlap_of_the_rule():
    from itertools import combinations

    for masks, n, k in [(decontaminate.MASKS, *x) for x in ((12, 2), (15, 3), (20, 4))] + [(decontaminate.SHORT_MASKS, *x) for x in ((6, 1), (10, 2))]:
        places = [frozenset(o + i for i, x in enumerate(m) if x == "1") for m in masks for o in range(n + 1 - len(m))]
        assert all(any(p.isdisjoint(s) for p in places) for s in combinations(range(n), k)), (n, k)


def test_substitutions_anywhere_are_reported(spark):
    cases = [(15, (0, 3)), (15, (0, 3, 14)), (12, (0, 11)), (12, (5, 6)), (12, (3, 8)), (6, (2,)), (7, (3,)), (8, (3,)), (10, (4, 5)), (11, (0, 6)), (72, tuple(range(12, 72, 4)))]
    items = [[f"w{n}x{i}" for i in range(n)] for n in sorted({n for n, _ in cases})] + [[f"s{i}" for i in range(5)]]
    whole = {len(x): x for x in items}
    docs = [" ".join(["a", *("zz" if i in at else w for i, w in enumerate(whole[n])), "b"]) for n, at in cases] + [" ".join(whole[5])]
    bench = spark.createDataFrame([(len(x), " ".join(x)) for x in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_equal) for r in decontaminate.contaminated(named(spark, docs), bench).collect()}
    assert got == {(i, n, holds([j not in at for j in range(n)], min(12, n))) for i, (n, at) in enumerate(cases)}
    before = decontaminate.drop_contaminated(named(spark, docs), bench).collect()
    assert [r.doc_id for r in before] == [len(cases)]


def test_rows_of_one_id_go_by_their_own_text(spark):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = named(spark, [item, "clean", None, "b " + item, "also clean", "x"], [None, None, None, 4, 4, 5])
    kept = decontaminate.drop_contaminated(df, bench).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == [(-1, ""), (-1, "clean"), (4, "also clean"), (5, "x")]


# pieces

ROUND = [
    None, "", " ", "  Hello  world ▁x\n\tfoo é 𝔘 ", "a\n\n b", "中文字符测试没有空格的句子" * 30, "a" * 3000, "x\r\ny", "\n", "ab" * 30 + " " * 20 + "q",
    "▁ ▁", "\x00", "The quick brown fox jumps over the lazy dog. " * 20,
]


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("sentencepiece")
    if not os.path.exists(pieces.MODEL):
        pytest.skip("no model file")
    return pieces.Vocabulary.load()


def test_plain_pieces_equal_the_library(vocabulary):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [t for t in ROUND if t and "▁" not in t]
    got = pieces.Codec(vocabulary, 0.0).encode(texts, range(len(texts)))
    assert [x.tolist() for x in got] == [sp.encode(t) for t in texts]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_every_text_decodes(vocabulary, rate):
    codec = pieces.Codec(vocabulary, rate)
    assert [codec.decode(x) for x in codec.encode(ROUND, range(len(ROUND)))] == ROUND


def test_full_dropout_leaves_characters(vocabulary):
    got = pieces.Codec(vocabulary, 1.0).encode(["abc de"], [0])[0]
    assert [vocabulary.pieces[i] for i in got] == ["▁", "a", "b", "c", "▁", "d", "e"]


def test_both_agendas_agree(vocabulary):
    codec = pieces.Codec(vocabulary, 0.2)
    own = sorted({w for t in ROUND if t for w in codec.cut(t) if 0 < len(w) <= pieces.SHORT})
    for variant in range(3):
        assert codec.encode_words(own, variant) == [codec.by_heap(w, codec.key(w, variant)) for w in own]


def test_seeds_repeat_and_vary(vocabulary):
    texts = ROUND[-1:] * 2
    one, same, other = (pieces.Codec(vocabulary, 0.3, seed=s).encode(texts, [1, 2]) for s in (1, 1, 2))
    assert all(np.array_equal(a, b) for a, b in zip(one, same))
    assert not np.array_equal(one[0], other[0]) and not np.array_equal(one[0], one[1])


def test_pieces_of_documents(spark, vocabulary):
    df = named(spark, [*ROUND, ROUND[-1]], [*range(len(ROUND)), None])
    got = pieces.encode(df)
    rows = got.collect()
    assert len(rows) == len(ROUND) + 1 and all(r.lossless for r in rows)
    assert all(r.pieces is None or r.n_pieces == len(r.pieces) for r in rows)
    back = {r.doc_id: r.text for r in pieces.decode(got).collect()}
    assert back == {**dict(enumerate(ROUND)), None: ROUND[-1]}
    assert pieces.encode(df.limit(0)).collect() == []


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_every_occurrence_has_its_own_draws(vocabulary, rate):
    codec = pieces.Codec(vocabulary, rate)
    texts, ids = [*ROUND, "international understanding " * 300, "the internationalization"], [*range(len(ROUND) + 1), None]
    got = codec.encode(texts, ids)
    for text, doc, found in zip(texts, ids, got):
        if text:
            words = codec.cut(text)
            one_by_one = [codec.by_heap(w, int(k)) for w, k in zip(words, codec.keys(doc, len(words)))]
            assert found.tobytes() == b"".join(one_by_one)
    words = codec.cut(texts[-2])
    forms = {codec.by_heap(w, int(k)) for w, k in zip(words, codec.keys(ids[-2], len(words))) if w == "▁understanding"}
    assert len(forms) > 4
    alone = codec.encode(texts[-2:-1], ids[-2:-1])[0]
    assert np.array_equal(alone, got[-2])


def test_a_frequent_word_takes_more_than_four_forms(vocabulary):
    codec = pieces.Codec(vocabulary, 0.3)
    texts = ["understanding"] * 400
    assert len({x.tobytes() for x in codec.encode(texts, range(400))}) > 8


def test_many_spans_in_one_text(spark):
    """Blocks and chunks end inside spans, gaps and characters beyond the basic plane."""
    import random

    r = random.Random(3)
    text, spans = "", []
    for i in range(1500):
        text += r.choice(["\U0001f600", " plain ", "é " * r.randrange(30), "\n", "mail "])
        value = f"a{i}@b{i}.org" if r.random() < 0.7 else f"10.0.{i % 256}.{r.randrange(256)}"
        text += " "
        spans.append(("email" if "@" in value else "ip", len(text), len(text) + len(value)))
        text += value + r.choice([" ", ",", "\U0001f680"])
    df = spark.createDataFrame([(1, text, len(text)), (2, None, None), (3, "none", 4)], "doc_id long, text string, n_chars long")
    row = pii.find_personal_data(df).where("doc_id = 1").first()
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert row.spans == listed
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
    for (kind, a, b), one in zip(spans, row.scored.split(",")):
        near = (text[max(a - 40, 0) : a] + " " + text[b : b + 40]).lower()
        score = pii.SCORES[kind] + 0.2 * bool(re.search(rf"(?a:\b)(?:{pii.CONTEXT[kind]})(?a:\b)", near))
        assert float(one.split(":")[3]) == pytest.approx(score), near
    expected, at = "", 0
    for kind, a, b in spans:
        expected += text[at:a] + f"[{kind.upper()}]"
        at = b
    expected += text[at:]
    got = {x.doc_id: (x.text, x.n_chars) for x in pii.redact(df).collect()}
    assert got == {1: (expected, len(expected)), 2: (None, None), 3: ("none", 4)}


def test_spans_of_one_text_take_linear_time(spark):
    import time

    def seconds(n):
        text = " ".join(f"user{i}@host{i}.org and words" for i in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        assert pii.find_personal_data(df).first().n_email == n
        return time.time() - start

    seconds(2000)
    assert seconds(32_000) < 8 * seconds(8000) + 2
