"""HTML extraction, archives and packing."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow.fs
import pytest

from assaykit.llm import html_paths, packing, warc
from assaykit.llm.queries import vocabulary

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body class="page"><header><h1>Site</h1></header><nav><ul><li><a href="/a">menu one</a></li></ul></nav>
<div id="cookie-banner">We use cookies, please agree to all of them, now.</div>
<article><header><h1>The  title</h1></header><p>First &amp; <b>bold</b>
text, here.</p><p><i>Open paragraph.<br><p>Next <span>one</span>&nbsp;stays.</p>
<div class="ad">Buy this, it is good.</div><table><tr><td>a | b<td>c</table><ul><li>item</ul>
<section class="comments"><p>Nice article, thanks a lot for it.</p></section></article>
<aside>Related, other, stories.</aside><form><label>Name</label><input></form>
<footer>&copy; nobody</footer></body></html>"""


def test_main_text():
    assert html_paths.main_text(PAGE).split("\n") == [
        "The title", "First & bold text, here.", "Open paragraph.", "Next one stays.", "a | b", "c", "item",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one<p>two", "one\ntwo"),
        ("<div><p>cut off <b>here</div", "cut off here"),
        ("<nav>only a menu</nav>", ""),
        ("<p>a &lt; b &#233; &bogus; c</p>", "a < b é &bogus; c"),
        ("<script>never ends", ""),
        ("</p></div>stray<p attr='>'>x", "stray\nx"),
        ("<!-- <p>no</p> --><p>yes", "yes"),
    ],
)
def test_small_pages(page, text):
    assert html_paths.main_text(page) == text


def test_pages_without_an_article():
    menu = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(30))
    body = "".join(f"<p>Sentence {i} goes on, and on, for a good while longer.</p>" for i in range(9))
    page = f"<body><div class=x><ul>{menu}</ul></div><div class=story><h2>Head</h2>{body}</div></body>"
    text = html_paths.main_text(page)
    assert text.startswith("Head\nSentence 0") and "link" not in text


@pytest.mark.parametrize("n", [80, 200, 3000])
def test_many_short_nodes_stay_with_their_article(n):
    long = "".join(f"<p>{'Some words, and more. ' * 140}</p>" for _ in range(3))
    items = [f"entry number {i} of all" for i in range(n)]
    lists = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    cells = "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in items) + "</table>"
    for short in (lists, cells):
        page = f"<body><nav><a>menu</a></nav><article><h1>Title</h1>{long}{short}</article></body>"
        got = html_paths.main_text(page).split("\n")
        assert got[0] == "Title" and len(got) == 4 + n and got[4:] == items


@pytest.mark.parametrize("name", ["has-sidebar", "comments-open", "ad-free", "category-social"])
@pytest.mark.parametrize(
    "holder", ["<article {}>{}</article>", "<main {}>{}</main>", "<div {}><article>{}</article></div>",
               "<div {}>{}</div>", "<main><article {}>{}</article></main>", "<main><div {}>{}</div></main>"],
)
def test_a_name_does_not_drop_the_page_text(name, holder):
    text = [f"Sentence {i} goes on, and on, for a good while longer." for i in range(5)]
    story = holder.format(f'class="post {name}"', "".join(f"<p>{x}</p>" for x in text))
    page = f'<body><nav>menu</nav><div class="sidebar"><p>See this, too.</p></div>{story}<footer>x</footer></body>'
    assert html_paths.main_text(page).split("\n") == text


def test_a_name_is_one_factor_among_others():
    text = "".join(f"<p>Sentence {i} goes on, and on, for a good while longer.</p>" for i in range(5))
    apart = '<section id="{}"><p>This part is as long, and as full of words, as others.</p></section>'
    page = f"<article>{text}{apart}</article>"
    assert "This part" in html_paths.main_text(page.format("discussion"))
    assert "This part" in html_paths.main_text(page.format("no-comments"))
    assert "This part" not in html_paths.main_text(page.format("comments"))


def test_extract(spark):
    rows = [(1, None, None, "x"), (2, "u", PAGE, None), (2, "u", PAGE, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_paths.extract(pages).orderBy("page_id").collect()
    assert [(r["page_id"], len(r["text"]) > 0) for r in got] == [(1, False), (2, True), (2, True)]
    assert html_paths.extract(pages.limit(0)).count() == 0


def pages_table(spark):
    big, other = "<p>" + "é words " * 300, "<p>" + "other words " * 200
    rows = [
        (1, "http://a/\r\n%0A", big), (2, None, big), (3, "u", big), (4, "u", other), (5, "u", "x"),
        (6, "u", "x"), (7, "u", None), (8, "u", ""), (None, "u", "y"), (9, "u", other), (9, "u", other),
    ]
    rows += [(100 + i, f"http://h/{i}", f"<p>page {i} " + "common text " * (i % 50 * 10)) for i in range(300)]
    return rows, spark.createDataFrame(
        [(*r, "q") for r in rows], "page_id long, url string, html string, payload string"
    )


def test_archive_round_trip(spark, tmp_path):
    rows, pages = pages_table(spark)
    manifest, folder = warc.archive(pages, f"file://{tmp_path}/archive")
    files = [p for p in (tmp_path / "archive").iterdir() if p.name.endswith(".warc.zst")]
    assert manifest.count() == len(files)
    for file in files:
        data = file.read_bytes()
        assert data[:4] == warc.DICTIONARY_FRAME
        assert all(r.startswith(b"WARC/1.1\r\n") for r in warc.frames(data))
    # a file of a lost attempt is not read
    (tmp_path / "archive" / "part-000000-999-0000.warc.zst").write_bytes(b"broken")
    got = warc.read(spark, manifest, folder).collect()
    assert len(got) == len(rows)
    payloads = {i: (html or "").encode() for i, _, html in rows}
    urls = {i: url for i, url, _ in rows}
    kinds = {}
    for r in got:
        want = payloads[r["page_id"]]
        kinds.setdefault(r["page_id"], []).append((r["record_type"], r["refers_to"]))
        assert r["payload_bytes"] == len(want)
        assert r["payload_digest"] == hashlib.sha1(want).hexdigest()
        assert r["url"] == urls[r["page_id"]]
        assert r["payload"] == (want if r["record_type"] == "response" else None)
    assert kinds[1] == kinds[2] == [("revisit", 3)] and kinds[3] == [("response", None)]
    assert kinds[4] == [("revisit", 9)] and kinds[9] == [("response", None)] * 2
    assert all(kinds[i] == [("response", None)] for i in (5, 6, 7, 8))
    store, root = pyarrow.fs.FileSystem.from_uri(f"file://{tmp_path}/archive")
    assert store.get_file_info(root).type == pyarrow.fs.FileType.Directory


def test_empty_archive(spark, tmp_path):
    pages = pages_table(spark)[1].limit(0)
    manifest, folder = warc.archive(pages, f"file://{tmp_path}/none")
    assert manifest.count() == 0 and warc.read(spark, manifest, folder).count() == 0


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    tokens, library = packing.Tokens(vocabulary()), Tokenizer.from_file(vocabulary())
    texts = [
        "", None, "a b  c\u2003d\u3000e", "x\x1cy z\x85q", "it's don't\n\n  foo\t\tbar  ", "<|endoftext|>",
        "“q” 12,5 é́", " " * 5000 + "end", "x" * 20000, "hello <|endoftext|> world", "<|endoftext|>" * 3,
        # too long a run for the faster encoder
        " " * 1_000_500, "\n" * 2_000_000, "x" + "\t \n" * 400_000 + "y", "\u3000" * 1_100_000 + "z",
        "a" * 300_000, "7" * 100_000, "日本" * 50_000,
    ]
    for text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert tokens.ids(text).tolist() == want, (text or "")[:20]
        assert tokens(text).tolist() == [*want, packing.END]
    assert tokens.ids("hello <|endoftext|> world").tolist() == [31373, 220, 50256, 995]


def test_ids_do_not_depend_on_earlier_texts():
    fresh, used = packing.Tokens(vocabulary()), packing.Tokens(vocabulary())
    for _ in range(40):
        used("ordinary words <|endoftext|>")
    for text in ("late <|endoftext|> mark", " " * 1_000_500 + "late", "plain é\u2003text"):
        assert np.array_equal(used(text), fresh(text))
        assert np.array_equal(used.ids(text), used._slow(text))


def test_a_text_that_the_encoder_refuses_goes_to_the_library(monkeypatch):
    class PanicException(BaseException):
        pass

    class Broken:
        def __init__(self, error):
            self.error = error

        def encode_ordinary(self, text):
            raise self.error

    tokens = packing.Tokens(vocabulary())
    want = tokens.ids("some text").tolist()
    for error in (PanicException(), ValueError()):
        monkeypatch.setattr(tokens, "fast", Broken(error))
        assert tokens.ids("some text").tolist() == want
    monkeypatch.setattr(tokens, "fast", Broken(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        tokens.ids("some text")


def test_packing_keeps_every_token_once(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame(
        [(10**6, None), (None, "a b"), (10**6 + 1, ""), (7, "twice"), (7, "twice")], "doc_id long, text string"
    )
    docs = table.select("doc_id", "text").union(odd).coalesce(2)
    tokens = packing.Tokens(vocabulary())
    rows = packing.pack(docs, vocabulary(), shard_tokens=60_000).collect()
    sequences, documents = {}, {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)  # no padding anywhere
    for row in docs.where("doc_id is null or doc_id <> 7").collect():
        parts = sorted(documents[row["doc_id"]], key=lambda r: r["start"])
        ids = b"".join(r["ids"] for r in parts)
        want = tokens(row["text"])
        assert ids == want.tobytes() and {r["doc_tokens"] for r in parts} == {len(want)}
        assert zlib.crc32(ids) == zlib.crc32(want.tobytes())
    assert sum(r["length"] for r in documents[7]) >= 2 * len(tokens("twice"))
    assert packing.pack(docs.limit(0), vocabulary()).count() == 0


def test_neighbours_equal_a_full_ranking():
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 400, rng.integers(5, 60)), 0).astype("<u4") for _ in range(80)]
    index = packing.Index(docs, query_terms=10**6, most_common=1.0)
    used = np.zeros(80, dtype=bool)
    used[:10] = True
    sizes = np.array([len(d) for d in docs])
    df = {t: sum(t in set(d.tolist()) for d in docs) for t in range(400)}
    for seed in (11, 40):
        scores = {}
        for d in range(10, 80):
            total = 0.0
            for t in set(docs[seed].tolist()) & set(docs[d].tolist()):
                if df[t] < 2 or df[t] > 80:
                    continue
                tf = (docs[d] == t).sum()
                idf = np.log(1 + (80 - df[t] + 0.5) / (df[t] + 0.5))
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes[d] / sizes.mean()))
            scores[d] = total
        got = index.neighbours(seed, used, most=5)
        assert sorted((round(scores[g], 3) for g in got), reverse=True) == [
            round(x, 3) for x in sorted(scores.values(), reverse=True)[:5]
        ]


def test_default_neighbours_are_all_that_share_a_term():
    rng = np.random.default_rng(4)
    docs = [np.append(rng.integers(1, 900, rng.integers(20, 90)), 0).astype("<u4") for _ in range(150)]
    docs = [np.append(d, [901, 902]).astype("<u4") if i % 3 == 0 else d for i, d in enumerate(docs)]
    n, sizes = len(docs), np.array([len(d) for d in docs])
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=903)
    index, used = packing.Index(docs), np.zeros(n, dtype=bool)
    used[[5, 9]] = True
    for seed in (0, 3, 70):
        scores = np.zeros(n)
        for d in range(n):
            for t in set(docs[seed].tolist()) & set(docs[d].tolist()):
                tf = (docs[d] == t).sum()
                idf = np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
                scores[d] += (df[t] > 1) * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sizes[d] / sizes.mean()))
        got = index.neighbours(seed, used)
        assert sorted(got) == [d for d in range(n) if d not in (5, 9)]  # all share the end-of-text id
        assert (np.diff(scores[got]) < 1e-5).all()


def test_a_window_takes_related_documents_first():
    # a third of the documents share two terms, and more than 64 fit in a window
    docs = [
        np.array([1, 2, 1000 + i, 0] if i % 3 == 0 else [5000 + i, 9000 + i, 20000 + i, 0], dtype="<u4")
        for i in range(450)
    ]
    pieces = packing.pack_shard(docs, 512)
    first = [p[0] for p in pieces if p[3] == 0]
    assert len(first) == 128 and all(d % 3 == 0 for d in first)
