"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from compare import differences
from pyspark.sql import functions as F

from nucleispark.llm import bpe, chat, decontaminate, html_text, language, near_duplicates, quality, queries, substring_dedup, transport, url_filter
from nucleispark.llm._text import grams, words

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOW))


def shingles(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    w = split(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs_of(spark, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]):
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), queries.ORACLES[name], FOLDER) == ""


def test_words_are_those_of_the_pattern():
    texts = ["", "A b-C, dé  f9!", "ünïcode ÄÖ x", "...", "one", "漢字 kana", "a\nb\tc"]
    for column in (pa.array(texts), pa.array(["x", *texts, None]).slice(1)):
        from nucleispark.llm._text import utf8

        data, at = utf8(column)
        w = words(data, at)
        low = bytes(data).decode()
        assert np.diff(w.first).tolist() == [len(split(t)) for t in column.to_pylist()]
        assert [bytes(data[a:b]).decode().translate(LOW) for a, b in zip(w.starts, w.ends)] == [x for t in column.to_pylist() for x in split(t)]
        assert low is not None
    same = words(*utf8(pa.array(["Ab cd", "xx aB"])))
    assert same.hashes[0] == same.hashes[3] and len(set(same.hashes.tolist())) == 3


# 1


def test_chats_keep_the_longest_snapshot(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c"), (4, 0, "user", "a"), (4, 1, "assistant", "x"),
        (5, 0, "user", "a"), (5, 1, "assistant", "b"), (5, 2, "user", "c"), (6, 0, None, None), (7, 0, "", ""), (None, 0, "user", "z"), (8, None, "user", "q"), (8, 0, "user", "r"),
    ]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"pos": F.lit("clash"), "hash": F.lit(0)})
    got = {r["conv_id"]: (r["n_turns"], r["n_copies"], r["chat"]) for r in chat.format_chats(conv).collect()}
    assert set(got) == {3, 4, 6, 7, 8} and got[3][:2] == (3, 2)
    assert got[3][2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert chat.format_chats(conv.filter("conv_id > 99")).count() == 0


def test_chats_against_brute_force(spark):
    rng = random.Random(5)
    convs = {i: [(rng.choice("ua"), rng.choice("xy")) for _ in range(rng.randint(1, 5))] for i in range(80)}
    rows = [(i, t, r, x) for i, c in convs.items() for t, (r, x) in enumerate(c)]
    got = {r["conv_id"] for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    want = {i for i, c in convs.items() if not any(len(o) > len(c) and o[: len(c)] == c or o == c and j < i for j, o in convs.items())}
    assert got == want


# 2


def test_url_rules_and_tokens(spark):
    urls = [
        "http://A.Example.com/en/1", "https://www.example.com/en/2", "http://x.com", "http://x.net/es/1?q=1", "ftp://net/fr/", "no scheme", None, "http://com/", "http://notcom/", "://?x", "http://h.net/de#a/b", "http://a.net/es",
    ]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.filter_urls(pages, queries.RULES).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/") and got[1][2] == "www.example.com/en/" and got[2] == ("x.com", "", None)
    assert got[3] == ("x.net", "/es/1", "net/es/") and got[4][2] == "net/fr/" and got[5] == got[6] == ("", "", None) and got[7][2] == "com/"
    assert got[8][2] is None and got[9] == ("", "", None) and got[10] == ("h.net", "/de", None) and got[11][2] is None
    assert url_filter.filter_urls(pages.filter("page_id > 99"), queries.RULES).count() == 0


def rules_plainly(rows, names, longest, min_support=0.02, min_confidence=0.8):
    rules = {}
    for n in range(1, longest + 1):
        for s in combinations(names, n):
            has = [lab for t, lab in rows if set(s) <= set(t)]
            for lab in ("block", "allow"):
                if has.count(lab) >= np.ceil(min_support * len(rows)) and has.count(lab) / len(has) >= min_confidence:
                    rules[s, lab] = has.count(lab) / len(has)
    return {(s, lab, round(c, 9)) for (s, lab), c in rules.items() if not any(o != s and set(o) < set(s) and ol == lab and oc >= c for (o, ol), oc in rules.items())}


def rules_mined(spark, rows):
    table = spark.createDataFrame(rows, "tokens array<string>, label string")
    mined = url_filter.mine(table, url_filter.items_of(table, 0.02), min_support=0.02, min_confidence=0.8).collect()
    assert all(r["index"] in r["items"] for r in mined)
    for r in mined:
        assert round(r["support"] * len(rows)) == sum(set(r["items"]) <= set(t) and lab == r["label"] for t, lab in rows)
    return {(tuple(r["items"]), r["label"], round(r["confidence"], 9)) for r in mined}


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        t = sorted({rng.choice("abcdef") for _ in range(rng.randint(1, 4))})
        rows.append((t, "block" if ("a" in t and rng.random() < 0.95) or rng.random() < 0.1 else "allow"))
    got = rules_mined(spark, rows)
    assert got == rules_plainly(rows, "abcdef", 4) and got


def test_optional_keys_against_brute_force(spark):
    """Eight keys, each in 90 % of the urls of one label or of both; one in those of one label alone."""
    rng = random.Random(8)
    for noise in (0.0, 0.1):
        rows = []
        for _ in range(250):
            t = [k for k in "abcdefgh" if rng.random() < 0.9] or ["a"]
            rows.append((t, "allow" if rng.random() < noise else "block"))
        rows = [([*t, "p"] if lab == "block" else t, lab) for t, lab in rows] + [(["z"], "allow")] * 50
        got = rules_mined(spark, rows)
        assert got == rules_plainly(rows, "abcdefghpz", 9) and (("p",), "block", 1.0) in got


def test_many_optional_keys_of_one_label(spark):
    """25 query keys, each in 90 % of 2,000 urls of a blocked shop: every token of the shop alone decides."""
    rng = random.Random(25)
    keys = [f"key{c}" for c in "abcdefghijklmnopqrstuvwxy"]
    rows = [("http://shop.org/list?" + "&".join(f"{k}=1" for k in keys if rng.random() < 0.9), "block") for _ in range(2000)] + [(f"http://b.net/x/{i}", "allow") for i in range(200)]
    pages = spark.createDataFrame([(0, "http://other.com/?keyc=4"), (1, "http://b.net/y"), (2, "http://other.com/?keyz=1")], "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["mined_tokens"]) for r in url_filter.filter_urls(pages, [], spark.createDataFrame(rows, "url string, label string")).collect()}
    assert got == {0: ("block", ["q=keyc"]), 1: ("allow", ["h1=net"]), 2: ("allow", None)}


def test_long_templates_are_one_item(spark):
    """200 urls under one path of 40 segments: each of its tokens alone decides, and mining takes no longer for it."""
    path = "/".join(f"part{'abcdefghij'[i // 4]}{'wxyz'[i % 4]}" for i in range(40))
    rows = [(f"http://a.org/{path}/{i}", "block") for i in range(200)] + [(f"http://b.org/x/{i}", "allow") for i in range(100)]
    labelled = spark.createDataFrame(rows, "url string, label string")
    urls = [(0, f"http://c.net/{path}/9?z=1"), (1, "http://c.net/q/w/e/partax/partbx"), (2, "http://b.org/y"), (3, None), (4, "http://d.net/")]
    pages = spark.createDataFrame([*urls, (0, urls[0][1])], "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["mined_tokens"]) for r in url_filter.filter_urls(pages, [], labelled).collect()}
    assert got == {0: ("block", ["p10=partcx"]), 1: ("allow", None), 2: ("allow", ["h2=b"]), 3: ("allow", None), 4: ("allow", None)}


# 3


def test_streams_round_trip(spark):
    rng = random.Random(1)
    texts = ["", "a", "é" * 288, "x" * 576, "x" * 577, prose(rng, 3000), None]
    docs = docs_of(spark, list(enumerate(texts))).withColumn("media", F.lit("clash"))
    got = {r["doc_id"]: r for r in transport.read_media(transport.to_media(docs)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        padded = raw + b"\xff" * (-len(raw) % 576) if raw else b"\xff" * 576
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["lost"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]), 0)
        assert r["media_bytes"] % 188 == 0
        assert r["random_access"] == [k * transport.TICKS for k in range(0, len(padded) // 576, transport.RANDOM_ACCESS)]
    assert got[0]["feature"] == got[6]["feature"]


def test_streams_show_loss_and_refuse_other_bytes():
    media = bytearray(transport.write_stream(np.arange(576 * 20, dtype=np.int64).astype(np.uint8)))
    assert transport.read_stream(bytes(media))["lost"] == 0
    assert transport.crc32_mpeg(b"123456789") == 0x0376E6E7
    gone = media[: 188 * 9] + media[188 * 10 :]
    assert transport.read_stream(bytes(gone))["lost"] == 1
    for other in (b"", b"x" * 188, bytes(media[:100]), bytes(media[188:376])):
        assert transport.read_stream(other) is None


def test_streams_of_other_writers():
    samples = np.arange(576 * 20, dtype=np.int64).astype(np.uint8)
    packets = [transport.write_stream(samples)[i : i + 188] for i in range(0, len(transport.write_stream(samples)), 188)]
    twice = b"".join(p * (2 if i in (5, 6, 30) else 1) for i, p in enumerate(packets))
    got = transport.read_stream(twice)
    assert got["lost"] == 0 and (got["samples"] == samples).all()
    info = bytes([0x80, 250]) + bytes(250)
    section = transport._section(2, 1, (0xE000 | transport.MEDIA_PID).to_bytes(2, "big") + (0xF000 | len(info)).to_bytes(2, "big") + info + bytes([6]) + (0xE000 | transport.MEDIA_PID).to_bytes(2, "big") + b"\xf0\x00")
    head = lambda start, n: bytes([0x47]) + ((0x4000 if start else 0) | transport.PMT_PID).to_bytes(2, "big") + bytes([0x10 | n])
    long = [head(True, 0) + b"\x00" + section[:183], (head(False, 1) + section[183:]).ljust(188, b"\xff")]
    got = transport.read_stream(b"".join([packets[0], *long, *(p for p in packets[1:] if p[1:3] != packets[1][1:3])]))
    assert got["lost"] == 0 and (got["samples"] == samples).all() and len(got["pts"]) == 20


def test_features_and_stored_form_are_those_of_the_bytes(spark):
    """Each stream taken apart packet by packet, with no code of the reader."""
    texts = [prose(random.Random(5), n) for n in (1, 90, 400)] + ["", None]
    docs = docs_of(spark, [*enumerate(texts), (1, texts[1])])
    stored = {r["doc_id"]: bytes(r["media"]) for r in transport.to_media(docs).collect()}
    for r in transport.read_media(transport.to_media(docs)).collect():
        media, raw = stored[r["doc_id"]], (texts[r["doc_id"]] or "").encode()
        padded = raw + b"\xff" * (-len(raw) % 576 or (0 if raw else 576))
        pes, units, access = b"", 0, 0
        for p in (media[i : i + 188] for i in range(0, len(media), 188)):
            if p[1:3] in (b"\x41\x00", b"\x01\x00"):
                skip = 5 + p[4] if p[3] & 0x20 else 4
                units += p[1] >> 6 & 1
                access += bool(p[3] & 0x20 and p[4] and p[5] & 0x40)
                pes += p[skip + 14 :] if p[1] & 0x40 else p[skip:]
        assert pes == padded and r["media_sha256"] == hashlib.sha256(media).hexdigest() and r["media_bytes"] == len(media)
        n, levels = len(padded), [sum(b >> 4 == k for b in padded) for k in range(16)]
        assert r["feature"] == f"units={units} access={access} last_pts={(n // 576 - 1) * 2160} lost=0 mean={sum(padded) * 1000 // n} square={sum(b * b for b in padded) * 1000 // n} levels={','.join(map(str, levels))}"
    assert transport.read_media(transport.to_media(docs.filter("doc_id > 99"))).count() == 0


# 4


def brute_links(texts: dict[int, str | None], t: float = 0.8) -> tuple[dict[int, int], dict[int, int]]:
    sets = {i: shingles(x) for i, x in texts.items()}
    links = {(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}
    root = {i: i for i in texts}
    for _ in texts:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    count = {i: sum(i in p for p in links) for i in texts}
    return root, count


def near_texts(rng: random.Random, groups: int, size: int) -> dict[int, str | None]:
    out, k = {}, 0
    for _ in range(groups):
        base = prose(rng, 120).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            out[k] = " ".join(w).title() if k % 3 else " ".join(w)
            k += 1
    return out


@pytest.mark.parametrize("block", [512, 6])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = random.Random(block)
    texts = near_texts(rng, 3, 16) | {100 + i: prose(rng, 60) for i in range(10)} | {200: "", 201: "", 202: None, 203: "one two", 204: "One, two!", 205: prose(rng, 20000), 206: "..."}
    docs = docs_of(spark, texts).withColumns({"class_id": F.lit("clash"), "key": F.lit(1), "root": F.lit(2)})
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_duplicates.near_duplicates(docs).collect()}
    root, count = brute_links(texts)
    assert got == {i: (root[i], count[i]) for i in texts}


def test_near_duplicates_of_odd_tables(spark):
    rng = random.Random(2)
    t = prose(rng, 50)
    rows = near_duplicates.near_duplicates(docs_of(spark, [(1, t), (1, t), (None, t), (3, t), (4, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["class_id"], r["n_links"]) for r in rows if r["doc_id"] is not None) == [(1, 1, 2), (1, 1, 2), (3, 1, 2), (4, 4, 0)]
    assert [(r["class_id"], r["n_links"]) for r in rows if r["doc_id"] is None] == [(None, None)]
    assert near_duplicates.near_duplicates(docs_of(spark, {1: t}).filter("doc_id > 9")).count() == 0


def test_pruning_follows_the_posterior():
    least = near_duplicates.least_agreements(0.8)
    x = (np.arange(200_000) + 0.5) / 200_000
    for h, m in ((32, int(least[32])), (96, int(least[96]))):
        tail = lambda m, h=h: (d := x**m * (1 - x) ** (h - m))[x >= 0.8].sum() / d.sum()
        assert tail(m) >= near_duplicates.TOLERANCE > tail(m - 1)


# 5

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class=x>
<header class="site-header"><h1>Site</h1></header><nav><a href=/>Home</a><p>menu text that is long enough to look like prose, really</p></nav><div class="cookie-notice">We use cookies</div>
<aside>side</aside><div id="main-12" class="story-7 wide"><h1>Head &amp; shoulders</h1><p>First   para
with <b>bold</b> and <a href="x">link</a>.<p>Second&nbsp;&eacute;&#233;<br>line<ul><li>one<li>two</ul><form><p>form</p></form><div class="ad">Buy</div><!-- <p>no</p> --></div>
<section class="comments"><p>reader comment that goes on and on and on and on and on and on, longer than the article itself, indeed much longer than that</p></section><footer>&copy; x</footer></body></html>"""


def test_pages_leave_all_but_the_article():
    found = html_text.main_text(PAGE)
    assert found == "Head & shoulders\n\nFirst para with bold and link.\n\nSecond éé line\n\none\n\ntwo"
    for odd in ("", "<", "<p", "<!-- x", "plain", "<p>a</p", "</div></p>", "<b><i>x</b></i>", "&am", "<script>x"):
        html_text.parse(odd)
    assert html_text.main_text("plain &lt; text") == "plain < text"


def test_pages_with_hostile_markup():
    text = html_text.main_text
    assert text("<p title=don't>hello</p><p>it's fine</p>") == "hello\n\nit's fine"
    assert text('<p class="x>hello world</p>') == "hello world" and text("<p a='b\">c'>d</p>") == "d" and text("<p a=b/>c</p>") == "c"
    assert text("<p>foo\u200bbar \ufeffbaz\u00a0\u2003 x</p>") == "foo\u200bbar \ufeffbaz x"
    assert text("<!--><p>a</p><!-- --!><p>b</p><!- x><?php y ?></ z><p>1 < 2 <3</p>") == "a\n\nb\n\n1 < 2 <3"
    assert text("<script>if (a < b) '</scripty>'</script><p>c</p></script><style>x</style >") == "c"
    prose = "word " * 40
    for name in ("widget-body", "social-science", "comments"):
        assert text(f"<body><div class='{name}'><h1>Head</h1><p>{prose}</p><p>{prose}</p></div></body>") == f"Head\n\n{prose.strip()}\n\n{prose.strip()}"
    inner = f"<p>{prose}</p><div class='ad'><p>Buy</p></div><form><p>Mail</p></form><ul class='share'><li>Tell</ul><section class=comments><p>{prose * 5}</p></section>"
    assert text(f"<article><h1>Head</h1>{inner}</article>") == f"Head\n\n{prose.strip()}"
    assert text(f"<form id=aspnet><div class=menu>x</div><div class=post><h1>Head</h1><p>{prose}</p></div></form>") == f"Head\n\n{prose.strip()}"


def test_deep_pages_cost_no_more_than_their_length():
    import time

    took = []
    for n in (5_000, 40_000):
        began = time.process_time()
        assert html_text.main_text("<div>" * n + "deep" + "</div></span></b>" * n) == "deep"
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.5


def test_pages_against_a_strict_parser():
    """Random well-formed pages of plain containers: every word of them is main text, in order, as a tree parser reads it."""
    from html.parser import HTMLParser

    rng = random.Random(41)

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.parts = []

        def handle_data(self, data):
            self.parts.append(data)

    def node(depth):
        kind = rng.choice(["p", "div", "section", "b", "text", "p"]) if depth else "section"
        attrs = rng.choice(["", " class='a b'", ' title="x > y"', " data-x=1", " id=n7 lang=en"])
        if kind == "text" or depth > 4:
            return f" {prose(rng, 3)} &amp; "
        if kind in ("p", "b"):
            return f"<{kind}{attrs}> {prose(rng, rng.randint(1, 9))} &eacute; <i>x</i> </{kind}>"
        return f"<{kind}{attrs}>" + "".join(node(depth + 1) for _ in range(rng.randint(1, 4))) + f"</{kind}>"

    for _ in range(200):
        page = f"<html><body><main>{''.join(node(0) for _ in range(3))}</main></body></html>"
        reader = Reader()
        reader.feed(page)
        reader.close()
        assert html_text.main_text(page).split() == "".join(reader.parts).split()


def test_pages_of_a_host_agree_on_a_path(spark):
    body = lambda n, extra="": f"<html><body><div class='post-{n}'>" + f"<p>{'word ' * 30}{n}</p>" * 4 + f"</div><div class='more'>{extra}</div></body></html>"
    noise = f"<p>{'other ' * 400}</p>"
    rows = [(i, f"http://a.com/{i}", body(i)) for i in range(8)] + [(8, "http://A.com/8", body(8, noise)), (9, None, body(9, noise)), (10, "http://b.com/", None), (11, "bad", ""), (12, "http://a.com/x", "<p>else</p>")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, winner string")
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert len(got) == 13 and "other" not in got[8]["text"] and "other" not in got[0]["text"]
    assert got[8]["text"].count("\n\n") == 3 and got[8]["n_chars"] == len(got[8]["text"])
    assert got[10]["text"] == got[11]["text"] == "" and got[12]["text"] == "else"
    assert html_text.extract(pages.filter("page_id > 99")).count() == 0


def test_articles_over_nested_containers_are_whole(spark):
    p = lambda name, n: "".join(f"<p>{name} {i} {'word ' * 30}</p>" for i in range(n))
    lead = f"<h1>Headline</h1><div class=lead>{p('lead', 1)}</div><div class=body>{p('body', 8)}</div>"
    kinds = {
        "a.com": (f"<article>{lead}</article>", 10),
        "b.com": ("<article>" + "".join(f"<section class=s{c}>{p(c, n)}</section>" for c, n in (("one", 2), ("two", 9), ("three", 1), ("four", 1), ("five", 1))) + "</article>", 14),
        "c.com": (f"<div class=wrap><div class=post>{lead}</div></div>", 10),
        "d.com": (f"<div class=post><section class=x>{p('x', 3)}</section><section class=y>{p('y', 3)}</section></div>", 6),
    }
    rows = [(i, f"http://{host}/{i}", f"<html><body><nav>menu</nav>{body}<div class=more>{p('other', 1)}</div></body></html>") for host, (body, _) in kinds.items() for i in range(3)]
    pages = spark.createDataFrame([*rows, *((i, None, t) for i, _, t in rows)], "page_id long, url string, html string")
    got = [(r["url"], r["text"]) for r in html_text.extract(pages).collect()]
    assert sorted(len(t.split("\n\n")) for u, t in got if u is None) == sorted(3 * [n for _, n in kinds.values()])
    for url, text in got:
        assert "other" not in text and (url is None or len(text.split("\n\n")) == kinds[url[7:12]][1])


PROSE = "<p>" + "Prose of the article goes on and on, with many words in it. " * 6 + "</p>"


@pytest.mark.parametrize(
    "extra",
    ['<header class="entry-header"><h1>Kept</h1></header>', '<section id="related-work"><p>Kept</p></section>', '<p class="share-price">Kept</p>', '<p class="form-letter">Kept</p>', '<h2 id="notice-period">Kept</h2>', "<p>Kept <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>"],
)
def test_names_cost_no_article_text(extra):
    text = html_text.main_text(f"<body><nav>Menu</nav><article>{extra}{PROSE}</article><footer>foot</footer></body>")
    assert text.startswith("Kept") and len(text.split("\n\n")) == 2 and "Menu" not in text and ("math" not in extra or text.startswith("Kept x=2"))


@pytest.mark.parametrize("extra", ['<div class="comments"><p>Gone</p></div>', '<div class="share">Gone</div>', '<div class="related-posts"><a href=x>Gone</a></div>', '<div class="post-share-buttons">Gone</div>', '<div class="cookie-notice">Gone</div>', '<section id="comments"><h3>Gone</h3><p>Gone</p></section>', '<ul class="social-links"><li>Gone</li></ul>'])
def test_what_stands_around_articles_still_goes(extra):
    assert "Gone" not in html_text.main_text(f"<body><article>{PROSE}{extra}</article></body>")


def test_stray_ends_cost_no_search():
    import time

    began = time.time()
    texts, _ = html_text.parse("<i>" + "<div>" * 40_000 + "x" + "</i>" * 40_000)
    assert texts == ["x"] and time.time() - began < 20


# 6


@pytest.mark.parametrize("block_words", [2_000_000, 15])
def test_decontamination_against_brute_force(spark, block_words):
    rng = random.Random(9)
    vocabulary = [prose(rng, 1) for _ in range(6)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, line(rng.randint(1, 14))) for k in range(3)] + [(k, prose(rng, 30)) for k in range(3, 8)] + [(20, None), (None, prose(rng, 12)), (21, ""), (7, prose(rng, 11))]
    texts = [line(rng.randint(0, 40)) for _ in range(30)] + [prose(rng, 15) + " " + " ".join(items[4][1].split()[5:19]).upper() + ", " + prose(rng, 9), " ".join(items[5][1].split()[:9]), None, "", items[6][1] * 2]
    texts += [prose(rng, 3000) + " " + items[3][1]]
    docs = docs_of(spark, list(enumerate(texts))).withColumns({"n_words": F.lit("clash"), "t": F.lit(0), "edges": F.lit(0)})
    bench = spark.createDataFrame(items, "item_id long, text string")
    judged = decontaminate.decontaminate(docs, bench, block_words=block_words, keep=["source"])
    got = {r["doc_id"]: r for r in decontaminate.digest(judged).collect()}
    windows: dict[tuple[str, ...], set[str]] = {}
    for k, t in items:
        w = split(t) if k is not None else []
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(str(k))
    for i, t in enumerate(texts):
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[tuple(w[p : p + n])]
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
        assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want


def test_decontamination_of_empty_tables(spark):
    docs, bench = docs_of(spark, {1: "a b c"}), spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.digest(decontaminate.decontaminate(docs, bench)).collect()] == [(1, 3, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert decontaminate.decontaminate(docs.filter("doc_id > 9"), bench).count() == 0


# 7


def test_quality_ranks_held_out_documents(spark):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op7_quality"](spark, "/root/testdata/sf0.1").collect()}
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(rows[i]["score"], q, rows[i]["predicted"]) for i, q in marks.items() if i in rows and zlib.crc32(str(i).encode()) % 5 == 0]
    good, bad = [s for s, q, _ in held if q == 1], [s for s, q, _ in held if q == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99
    assert np.mean([p == q for _, q, p in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())


def test_quality_of_odd_tables(spark):
    rng = random.Random(4)
    docs = docs_of(spark, [(1, None), (2, ""), (3, prose(rng, 5000)), (3, "x x x x x"), (None, "words here")]).withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(3, 1), (3, 1), (None, 0), (2, None)], "doc_id long, quality int"), spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, quality int")):
        got = quality.score(docs, quality.train(docs, labels)).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert got[0]["score"] == got[1]["score"] or len({r["doc_id"] for r in got}) == 4


# 8


def test_bpe_is_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    signs = "aAbBİΣsσ é́漢字 123½²'s't'll  \t\n​🎉👩‍👩‍👧<|startoftext|>ß<|endoftext|>_-.,!ΩÅKﬁ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["<|startoftext|>hello<|endoftext|>", "aaaa aaaaaaa", "", "ΟΔΟΣ", "I'M he'd WE'LL", prose(rng, 20000), None, "a" * 3000]
    library = Tokenizer.from_file(queries.tokenizer_path())
    docs = docs_of(spark, list(enumerate(texts))).withColumns({"n_tokens": F.lit("clash"), "t": F.lit(0), "k": F.lit(0)})
    for r in bpe.encode(docs, queries.tokenizer_path()).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r["token_ids"] == ids and r["decoded"] == back and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.encode(docs.filter("doc_id > 9999"), queries.tokenizer_path()).count() == 0


# 9


def test_language_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_language_id"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    held = [rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert np.mean(held) > 0.98 and all(0 <= r["score"] <= 1 for r in rows.values())
    clean = [r["rejected"] for i, r in rows.items()]
    assert np.mean(clean) < 0.01


def test_language_of_odd_texts(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (3, "123 ... !"), (4, "the"), (4, "the"), (None, "é"), (6, "word " * 30000)]).withColumn("lang_pred", F.lit("clash"))
    got = [tuple(r)[1:] for r in language.identify(docs, language.train(docs)).orderBy("doc_id", "score").collect()]
    assert sum(g[0] == "und" and g[2] for g in got) == 3 and {g[0] for g in got} == {"und", "en"}
    empty = docs.filter("doc_id > 99")
    assert language.identify(empty, language.train(empty)).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.train(empty)).collect()} == {"und"}


# 10


def test_compact_windows_hold_each_range_once():
    rng = np.random.default_rng(0)
    for trial in range(40):
        sizes = rng.integers(0, 40, 4)
        first = np.stack([np.cumsum(sizes) - sizes, np.cumsum(sizes)], 1)
        values = (rng.permutation(int(sizes.sum())) if trial % 2 else rng.integers(0, 9, int(sizes.sum()))).astype(np.uint64)
        width = int(rng.integers(1, 9))
        valid = np.zeros(len(values), bool)
        for a, b in first:
            valid[a : max(a, b - width + 1)] = True
        c, low, high = substring_dedup.compact_windows(values, valid, first, width)
        for a, b in first:
            for i in range(a, b):
                for j in range(i + width - 1, b):
                    at = i + int(values[i : j + 1].argmin())
                    assert ((c == at) & (low <= i) & (high >= j)).sum() == 1, trial
        assert (high - low + 1 >= width).all()


def test_places_pack_and_unpack():
    c, left, right = np.array([0, 5, 1 << 31]), np.array([0, 2, (1 << 31) - 10]), np.array([9, 5, (1 << 31) + 50])
    for fn in range(substring_dedup.HASHES):
        assert substring_dedup.unpack(substring_dedup.pack(fn, c, left, right)).tolist() == [[fn] * 3, c.tolist(), left.tolist(), right.tolist()]


def planted(rng: random.Random) -> tuple[dict[int, str | None], set[int]]:
    """Texts, and those that repeat over 50 words of an earlier one."""
    passage, other = prose(rng, 70).split(), prose(rng, 60).split()
    texts: dict[int, str | None] = {i: prose(rng, 150) for i in range(20)}
    repeats = set()
    for i in range(20, 45):
        p = list(passage if i % 2 else other)
        if i % 5 == 0:
            p[len(p) // 2] = "changed"
        texts[i] = f"{prose(rng, 40)} {' '.join(p).upper()}, {prose(rng, 30)}"
        repeats.add(i)
    repeats -= {20, 21}
    short = " ".join(prose(rng, 20).split())
    texts |= {i: f"{prose(rng, 60)} {short} {prose(rng, 60)}" for i in range(50, 70)}
    texts |= {80: texts[0], 81: None, 82: "", 83: "a b", 84: f"{prose(rng, 20000)} {' '.join(passage)}"}
    return texts, repeats | {80, 84}


def test_repeated_passages_are_found_and_clean_texts_left(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SAMPLE", 2)
    monkeypatch.setattr(substring_dedup, "SHARE", 100)
    texts, repeats = planted(random.Random(8))
    docs = docs_of(spark, texts).withColumns({"doc": F.lit("clash"), "key": F.lit(0), "n_words": F.lit("clash")})
    rows = substring_dedup.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in rows} == repeats
    for r in rows:
        a, b = split(texts[r["doc_id"]])[r["start_word"] : r["end_word"]], split(texts[r["kept_id"]])[r["kept_start"] : r["kept_end"]]
        x, y = shingles(" ".join(a)), shingles(" ".join(b))
        assert r["kept_id"] < r["doc_id"] and len(a) == r["n_words"] >= 50 and len(x & y) / len(x | y) == pytest.approx(r["similarity"], abs=1e-5) and r["similarity"] >= 0.8
    whole = [r for r in rows if r["doc_id"] == 80]
    assert (whole[0]["start_word"], whole[0]["end_word"]) == (0, 150)
    assert substring_dedup.repeated_passages(docs.filter("doc_id > 999")).count() == 0


@pytest.mark.parametrize("between", [0, 6])
def test_passages_of_frequent_lines_are_found(spark, between):
    """Each pair's passage of two lines; documents before and between them hold one of the lines each."""
    rng = random.Random(31)
    texts: dict[int, str | None] = {}
    pairs = set()
    for n in range(40):
        line = [prose(rng, 40), prose(rng, 40)]
        alone = lambda i: f"{prose(rng, 30)} {line[i % 2]} {prose(rng, 30)}"  # noqa: E731, B023
        at = 100 * n
        texts |= {at + i: alone(i) for i in range(4)} | {at + 10 + i: alone(i) for i in range(between)}
        texts |= {i: f"{prose(rng, 30)} {' '.join(line)} {prose(rng, 30)}" for i in (at + 5, at + 50)}
        pairs.add((at + 50, at + 5))
    rows = substring_dedup.repeated_passages(docs_of(spark, texts)).collect()
    assert {(r["doc_id"], r["kept_id"]) for r in rows} == pairs
    assert all(r["n_words"] == 80 for r in rows)


def test_dealing_leaves_the_result_as_it_is(spark, monkeypatch):
    rng = random.Random(32)
    line = [prose(rng, 40), prose(rng, 60)]
    texts = {i: f"{prose(rng, 20)} {line[i % 2]} {prose(rng, 20)} {line[i % 3 % 2]} {prose(rng, 20)}" for i in range(60)}
    docs = docs_of(spark, texts)
    rows = docs.select(F.col("doc_id").alias("doc"), "text")
    sides = []
    for sample in (1, 64):
        monkeypatch.setattr(substring_dedup, "SAMPLE", sample)
        assert (len(substring_dedup.frequent_keys(rows, 5, 46)) > 3) == (sample == 1)
        sides.append(sorted(map(tuple, substring_dedup.repeated_passages(docs).collect())))
    assert sides[0] == sides[1] and sides[0]


def longest_common(a: list[str], b: list[str]) -> int:
    """Words of the longest run that both have."""
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [before[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best, before = max(best, max(row)), row
    return best


def test_every_verbatim_repeat_of_all_pairs_is_found(spark):
    """Texts made of a few frequent lines of 12 to 60 words in random order, so that first holders have parts only."""
    rng = random.Random(33)
    lines = [prose(rng, n) for n in (12, 20, 25, 30, 40, 44, 46, 48, 49, 60)]
    texts = {i: " ".join(rng.choice(lines) if rng.random() < 0.6 else prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 7))) for i in range(90)}
    rows = substring_dedup.repeated_passages(docs_of(spark, texts)).collect()
    hit = {i: set() for i in texts}
    for r in rows:
        hit[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    earlier: set[tuple[str, ...]] = set()
    n = 0
    for i, text in texts.items():
        w = split(text)
        for p in range(len(w) - 49):
            if tuple(w[p : p + 50]) in earlier:
                n += 1
                assert hit[i] >= set(range(p, p + 50)), (i, p)
        earlier |= {tuple(w[p : p + 50]) for p in range(len(w) - 49)}
    assert n > 300


@pytest.mark.parametrize("crowd", [0, 4])
def test_near_repeats_of_all_pairs(spark, crowd):
    """Passages of 50 to 60 words with a changed word in the middle or none, some of whose halves stand in other documents too."""
    rng = random.Random(34)
    texts, want = {}, set()
    for n in range(120):
        p = prose(rng, rng.randint(51, 60)).split()
        q = list(p)
        if n % 3:
            q[rng.randrange(20, 30)] = "changed"
        x, y = shingles(" ".join(p)), shingles(" ".join(q))
        halves = [" ".join(p[:30]), " ".join(p[25:])]
        texts |= {1000 * n + c: f"{prose(rng, 20)} {halves[c % 2]} {prose(rng, 20)}" for c in range(crowd)}
        texts |= {1000 * n + 100: f"{prose(rng, 30)} {' '.join(p)} {prose(rng, 30)}", 1000 * n + 200: f"{prose(rng, 25)} {' '.join(q)} {prose(rng, 30)}"}
        if len(x & y) / len(x | y) >= 0.8:
            want.add((1000 * n + 200, 1000 * n + 100))
    rows = substring_dedup.repeated_passages(docs_of(spark, texts)).collect()
    got = {(r["doc_id"], r["kept_id"]) for r in rows}
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) > 60


@pytest.mark.parametrize("holders", [1, 2, 6, 20])
def test_holders_of_parts_hide_no_near_repeat(spark, holders):
    """Passages of 60 words with a word changed, added or left out, of which earlier documents hold 45 words."""
    rng = random.Random(35)
    texts, want = {}, set()
    for n in range(120):
        p = prose(rng, 60).split()
        q = p[:30] + (["changed"], ["added", p[30]], [])[n % 3] + p[31:]
        for h in range(holders):
            at = rng.randint(0, 15)
            texts[1000 * n + h] = f"{prose(rng, 20)} {' '.join(p[at : at + 45])} {prose(rng, 20)}"
        texts |= {1000 * n + 100: f"{prose(rng, 30)} {' '.join(p)} {prose(rng, 30)}", 1000 * n + 200: f"{prose(rng, 25)} {' '.join(q)} {prose(rng, 30)}"}
        want.add((1000 * n + 200, 1000 * n + 100))
    got = {(r["doc_id"], r["kept_id"]) for r in substring_dedup.repeated_passages(docs_of(spark, texts)).collect()}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_rows_that_share_an_id_or_have_none(spark):
    t = prose(random.Random(6), 100)
    other = prose(random.Random(7), 100)
    rows = substring_dedup.repeated_passages(docs_of(spark, [(1, t), (1, t), (None, t), (2, t), (2, t), (2, other), (3, other)])).collect()
    assert {(r["doc_id"], r["kept_id"], r["n_words"]) for r in rows} == {(2, 1, 100), (3, 2, 100)}
    assert len({r["text_key"] for r in rows}) == 2


def test_spans_are_cut_by_words():
    texts = pa.array(["One, two three. Four!", "é b c", "x"])
    assert substring_dedup.without_spans(texts, [[(1, 3)], [(0, 1), (0, 2)], []]) == ["One, . Four!", " c", "x"]


def test_grams_need_all_words():
    assert len(grams(np.arange(3, dtype=np.uint64), 5)) == 0
