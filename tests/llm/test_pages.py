import numpy as np
import pytest

from harvestline.llm import pages as P
from harvestline.llm.common import table


@pytest.fixture(scope="module")
def net(spark):
    return P.fit(table(spark, "/root/testdata/sf0.001", "pages"))


def texts(page):
    return [b.text for b in P.parse(page)]


def test_blocks():
    assert texts("<p>a  b<br>c &amp; d<p>e<b>f</b></div>g") == ["a b c & d", "ef", "g"]
    assert texts("<script>if (a<b) x='</p>';</script><style>p{}</style><!-- <p>no</p> --><p title='a>b'>yes") == ["yes"]
    assert texts("a < b &lt;i&gt; &#x41;&nbsp;&copy; &amp") == ["a < b <i> A © &"]
    assert texts("") == [] and texts("<p></p> \n") == [] and texts("<p") == []
    assert P.parse("<div class='x-Side bar' id=main><p>t")[0].path == ("div", ".x", ".side", ".bar", ".main", "p")


def test_labels_follow_the_article_on_unseen_pages(net, spark):
    rows = table(spark, "/root/testdata/sf0.01", "pages").collect()
    blocks = [P.parse(r.html) for r in rows]
    found = P.label(net, blocks)
    assert sum((P.weak_labels(b) != f).any() for b, f in zip(blocks, found, strict=True)) == 0


def test_other_frames(net):
    page = ("<html><body><div class=header><a href=/>Home</a></div><div class='entry-content'><h1>Title</h1><p>The first paragraph of a story"
            " that goes on for a while.<p>And the second one, which is as long as that.</div><div class=comments><p>I do not agree"
            " with any of this, but thank you.</div><div class=footer>&copy; 2020 somebody</div></body></html>")
    assert P.main_text(net, [page]) == ["Title\n\nThe first paragraph of a story that goes on for a while.\n\nAnd the second one, which is as long as that."]


def test_gradients():
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(4, 2, 5)).astype(np.float64), np.ones((4, 2, 1))
    mask[2:, 1] = 0
    wx, wh, b = rng.normal(size=(5, 4 * P.HIDDEN)) * 0.3, rng.normal(size=(P.HIDDEN, 4 * P.HIDDEN)) * 0.3, rng.normal(size=4 * P.HIDDEN) * 0.1
    goal = rng.normal(size=(4, 2, P.HIDDEN))
    loss = lambda: float((P.lstm(x, mask, wx, wh, b)[0].astype(np.float64) * goal).sum())
    _, tape = P.lstm(x, mask, wx, wh, b)
    dx, dwx, dwh, db = P.lstm_back(goal, x, mask, wx, wh, tape)
    for value, grad in ((x, dx), (wx, dwx), (wh, dwh), (b, db)):
        for _ in range(4):
            k = tuple(int(rng.integers(n)) for n in value.shape)
            old = value[k]
            value[k] = old + 1e-2
            up = loss()
            value[k] = old - 1e-2
            down = loss()
            value[k] = old
            assert abs((up - down) / 2e-2 - grad[k]) < 2e-2 * max(1, abs(grad[k]))


def test_long_pages_batches_and_edge_cases(net, spark):
    long = "<html><body><article>" + "".join(f"<p>Paragraph number {k} of a long page.</p>" for k in range(3000)) + "</article></body></html>"
    rows = [(1, "u", long, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<<<>>> &bogus; <p <p>", "x"), (1, "u", long, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = P.extract(df, net).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 5 and by[1].text.count("\n\n") == 2999 and by[1].n_chars == len(by[1].text)
    assert by[2].text == by[3].text == "" and by[2].n_chars == 0
    assert P.extract(df.limit(0), net).count() == 0
    assert P.train(["<p>no main element</p>", ""]) is None
    assert P.main_text(None, [long[:200], "<p>x"])[1] == ""


def test_open_quotes_take_linear_time():
    """A quote that nothing closes ends with its tag, at the next ">"."""
    import time

    began = time.time()
    assert P.parse("<a " * 30_000 + '"') == []
    assert P.parse("<a \"'" * 30_000) is not None
    assert time.time() - began < 5
    assert [b.text for b in P.parse("<p class='x>one</p><p title=\"a>b\">two</p>")] == ["one", "two"]


def test_every_word_and_name_counts():
    words = [f"w{k}" for k in range(200)]
    one = P.Block(tuple(f"n{k}" for k in range(60)), " ".join(words), 0.0)
    names, found, _ = P.features([one])
    assert len(found[0]) == 200 and len(names[0]) == 61
    net = P.new_labeller(np.random.default_rng(0))
    at = lambda b: P.embed(net, P.padded([P.features([b])])[0])[0, 0]
    for k in range(0, 200, 13):  # any word moves the mean, any name the sum
        assert (at(P.Block(one.path, " ".join([*words[:k], "other", *words[k + 1:]]), 0.0)) != at(one)).any()
    assert (at(P.Block(("other", *one.path[1:]), one.text, 0.0)) != at(one)).any()
    assert "." + "k" in P.parse("<div class='a b c d e f g h i j k'><p>t")[0].path
    two = P.padded([P.features([one, P.Block((), "a b", 0.0)]), P.features([one])])
    x = P.embed(net, two[0])
    assert np.allclose(x[0, 0], at(one)) and np.allclose(x[0, 1], at(one)) and (x[1, 1] == 0).all() and two[1][1, 1] == 0
