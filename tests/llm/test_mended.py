"""Fit samples at any size, deep pages, pieces without blanks, scripts and spellings of personal data, short blocks of a marked article."""

import os
import random
import time

import pytest

from tablesmith.llm import html_extract, pii, token_counts, toxicity
from tablesmith.llm.queries import tokenizer_file

KEY = b"k" * 32
ARTICLE = ("<article><h1>Head</h1><table><tr><td>1</td><td>2</td></tr></table><ul><li><a href=x>link</a></li></ul>"
           "<p>text here</p><figure><figcaption>cap</figcaption></figure><blockquote>last</blockquote></article>")


def test_shares_are_never_nothing():
    for counts in ({0: 4 * 10 ** 10, 1: 10 ** 7}, {0: 10 ** 13, 1: 5}, {0: 90, 1: 10}):
        share = toxicity.shares(counts, 16_000)
        assert all(p * 2 ** 40 >= 1 or counts[y] * p >= 1_000 for y, p in share.items())
        for label, n in counts.items():
            assert share[label] * n >= min(n, 1_599)
    assert toxicity.shares({0: 90, 1: 10}, 16_000) == {0: 1.0, 1: 1.0}


def test_a_rare_label_is_learned(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(rng.choices(words, k=20)) + (" vile scum" if k % 100 == 0 else "")) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 100 == 0)) for k, _ in rows], "doc_id long, label int")
    which, w, bias = toxicity.fit_weights(docs, labels, fit_docs=600)
    model = which, w, bias
    scored = docs.select("doc_id", toxicity.toxicity(docs["text"], model).alias("p")).collect()
    bad = [r.p for r in scored if r.doc_id % 100 == 0]
    good = [r.p for r in scored if r.doc_id % 100]
    assert len(which) and min(bad) > 0.5 and max(good) < 0.5


def test_all_labelled_pages_are_used_if_few(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(html_extract, "weights", lambda counts: seen.append(counts))
    page = "<article><p>some words in here {}</p></article>"
    rows = [(k, page.format(k) if k % 20 == 0 else f"<div><p>plain {k}</p></div>") for k in range(250)]
    html_extract.fit_weights(spark.createDataFrame(rows, "page_id long, html string"), fit_pages=50)
    assert sum(n for (feature, inside), n in seen[0].items() if "article" in feature or inside) > 0
    html_extract.fit_weights(spark.createDataFrame([r for r in rows if r[0] % 20 == 0], "page_id long, html string"), 50)
    assert seen[0] == seen[1]  # the other pages change nothing


def test_short_blocks_of_an_article_stay():
    model = html_extract.weights({})
    menu = "<nav><a href=1>Home</a><a href=2>About us all</a></nav>"
    foot = "<footer><p>all rights reserved by someone</p></footer>"
    got = html_extract.main_text(f"<html><body>{menu}{ARTICLE}{foot}</body></html>", model)
    assert got == "Head\n1\n2\nlink\ntext here\ncap\nlast"


@pytest.mark.parametrize("text", [
    "иван.петров@почта.рф", "张伟@example.com", "+١ ٥٥٥ ١٢٣ ٤٥٦٧", "۰۲۱-۱۲۳-۴۵۶۷", "José.Müller@x.de", "١٢٣-٤٥-٦٧٨٩",
    "٤١١١ ١١١١ ١١١١ ١١١١", "de89 3704 0044 0532 0130 00", "+४४ २०७९४६ ०९५८", "ΜΑΡΙΑ.papa@x.gr"])
def test_values_of_other_scripts_change(text):
    new, found = pii.pseudonymised(f"see {text} there", KEY)
    assert len(found) == 1 and text not in new and new.startswith("see ") and new.endswith(" there")
    assert pii.pseudonymised(f"see {text} there", KEY) == (new, found)


def test_found_means_changed():
    rng = random.Random(9)
    letters = "abzÄéжЖя中文ñß_.-+"
    for _ in range(500):
        local = "".join(rng.choices(letters, k=rng.randrange(8, 16))).strip(".-+").replace("..", "a.") or "a"
        new, found = pii.pseudonymised(f"{local}@example.org", KEY)
        for _, start, end in found:
            assert new[start:end] != f"{local}@example.org"[start:end]
    assert pii.pseudonymised("___@example.org", KEY) == ("___@example.org", [])


def test_spellings_of_one_number_share_a_pseudonym():
    digits = lambda t: pii.ascii_digits(pii.pseudonymised(t, KEY)[0])
    one = {digits(t) for t in ("+1 555 123 4567", "+15551234567", "+1-555-123-4567", "+١ ٥٥٥ ١٢٣ ٤٥٦٧", "+1 (555) 123 4567")}
    assert len(one) == 1 and one.pop()[1:] == digits("(555) 123-4567") == digits("555-123-4567")
    assert digits("+44 20 7946 0958") == digits("+442079460958") and digits("+442079460958").startswith("44")
    assert digits("+380 44 123 4567").startswith("380")


def test_permutations_of_other_alphabets_are_one_to_one():
    for sign in "aЯя٣é":
        some = pii.alphabet(pii.lower(sign))
        assert len({pii.permuted(c + "7", KEY, "t") for c in some}) == len(some) > 1


@pytest.mark.parametrize("page", [
    *(f"<{t}>" * 200_000 + "hello" for t in ("div", "i", "p", "li", "div class=comments")),
    "<div>" * 100_000 + "hello" + "</b>" * 100_000,
    "<div>" * 50_000 + "hello" + "</i><td><p>" * 50_000])
def test_deep_pages_take_linear_time(page):
    start = time.perf_counter()
    html_extract.main_text(page, html_extract.weights({}))
    assert time.perf_counter() - start < 30  # a walk over the open elements per tag takes most of an hour


def test_open_elements_close_by_name():
    opened = html_extract.OpenElements()
    for name in ("article", "div", "p", "i", "main", "i"):
        opened.push(name, False, 0)
    assert opened.last("i") == 5 and opened.last("p", "div") == 2 and opened.last("td") == -1
    assert list(opened.ended_by("div")) == []  # the innermost block is main, so the p stays
    assert opened.close(3) == 1 and [e[0] for e in opened.stack] == ["article", "div", "p"]
    assert opened.last("i") == -1 and opened.blocks == [0, 1, 2]
    assert list(opened.ended_by("div")) == [2]


def test_fitted_weights_decide_on_unmarked_pages(spark):
    """Where articles are lists of links, an unmarked page's list of links is its main text; unfitted it isn't."""
    items = "".join(f"<ul><li><a href=x>entry {k} of the list</a></li></ul>" for k in range(20))
    rows = [(k, f"<body><div>{'aside words here ' * 5}</div><article>{items}</article></body>") for k in range(40)]
    fitted = html_extract.fit_weights(spark.createDataFrame(rows, "page_id long, html string"))
    page = f"<body><p>{'one paragraph ' * 3}</p>{'<div>' * 6}{items}{'</div>' * 6}</body>"
    plain = html_extract.main_text(page, html_extract.weights({}))
    assert "entry 19 of the list" in html_extract.main_text(page, fitted)
    assert "entry 19 of the list" not in plain and plain.startswith("one paragraph")


def test_long_pieces_are_counted_but_not_remembered():
    counter = token_counts.PieceCounter(tokenizer_file())
    texts = ["x" * 5_000, "語" * 300 + " a", "short words here", "y" * 64, "y" * 65, "x" * 5_000 + "\n" + "x" * 5_000]
    want = [len(counter.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert counter.count(texts) == want
    assert counter.known and max(map(len, counter.known)) == 64


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts():
    public = os.path.join(os.path.dirname(tokenizer_file()), "byte_bpe_50k.json")
    counter = token_counts.PieceCounter(public)
    texts = ["hello  world \n\n foo", " a b\tc ", "", None, "x" * 3_000]
    assert not counter.cuts
    assert counter.count(texts) == [len(counter.tokenizer.encode(t or "", add_special_tokens=False)) for t in texts]
