"""Simple tree matching of the page wrapper, and pages whose tags say nothing."""

import random
import re

from registry_analytics.llm import wrapper

SF = "/root/testdata/sf0.01"


def random_tree(pick, size):
    """A tree's shape: depth and label of each node."""
    lines, depth = ["0 r"], 0
    for _ in range(size):
        depth = pick.randint(1, depth + 1)
        lines.append(f"{depth} {pick.choice('abc')}")
    return "\n".join(lines)


def brute_matching(a, b):
    """The same, over every choice: drop a first child of either side, or pair both."""
    if a.label != b.label:
        return 0

    def below(x, y):
        if not x or not y:
            return 0
        return max(below(x[1:], y), below(x, y[1:]), brute_matching(x[0], y[0]) + below(x[1:], y[1:]))

    return 1 + below(a.children, b.children)


def test_matching_against_the_plain_recursion():
    pick = random.Random(5)
    for _ in range(150):
        a, b = (wrapper.tree_of(random_tree(pick, pick.randint(0, 9))) for _ in range(2))
        found, pairs = wrapper.matching(a[0], b[0]), wrapper.partners(a[0], b[0])
        assert found == brute_matching(a[0], b[0]) == len(pairs) == len(set(pairs.values()))
        for x, y in pairs.items():
            assert a[x].label == b[y].label and (x == y == 0 or pairs[a[x].parent.index] == b[y].parent.index)
        order = [pairs[x] for x in sorted(pairs)]
        assert order == sorted(order)


def test_alike_siblings_are_one_list_and_others_are_not():
    page = wrapper.Page("<body><div>ad</div><div><h1>t</h1><p>a<p>b<p>c</div><div><ul><li>x<li>y</ul></div><div>end</div></body>")
    assert page.shape.split("\n") == ["0 #root", "1 body", "2 div", "2 div", "3 h1", "3 p", "2 div", "3 ul", "4 li"]
    assert [(node.index, text) for node, text, _, _ in page.blocks] == [(2, "ad"), (4, "t"), (5, "a"), (5, "b"), (5, "c"), (8, "x"), (8, "y"), (2, "end")]


def test_unpaired_nodes_keep_one_key_in_every_shape():
    centre = wrapper.Page("<body><div><p>a</div></body>").shape
    first, second = (wrapper.Page(f"<body>{extra}<div><p>a</div><ul><li>x</ul></body>").shape for extra in ("", "<table><tr><td>q</table>"))
    at = [wrapper.aligned("h", shape, centre) for shape in (first, second)]
    place = [[line for line in shape.split("\n")].index("2 ul") for shape in (first, second)]
    assert at[0].keys[place[0]] == at[1].keys[place[1]] and at[0].partner[place[0]] == -1
    assert all(len(set(x.keys)) == len(x.keys) for x in at)


def neutral(html):
    """The page without what its elements' names, classes, ids and roles say."""
    if html is None:
        return None
    html = re.sub(r"<(/?)(article|main|nav|header|footer|aside|section)\b", r"<\1div", html)
    return re.sub(r"""\s(class|id|role)=("[^"]*"|'[^']*'|[^\s>]+)""", "", html)


def texts(spark, rows):
    return {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}


def test_neutral_pages_give_the_texts_of_the_named_ones(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    named = {r.page_id: r.text for r in wrapper.extract(pages).collect()}
    got = texts(spark, [(r.page_id, r.url, neutral(r.html)) for r in pages.collect()])
    assert sum(got[k] == named[k] for k in named) >= 0.95 * len(named)


def test_the_wrapper_decides_on_neutral_pages(spark):
    """The slot and the template come from the other pages of the host: the same page alone keeps its footer and advert."""
    page = (
        "<html><body><div><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div><div>{1} offer {0}</div>"
        "<div><h1>Title {0}</h1><div><p>Always the same line.</p><p>Story {0} has many words that no other page of the host has, and goes on for some more lines of words.</p><p>More of {0}.</p></div></div><div>Printed in town</div></body></html>"
    )
    rows = [(i, f"http://h.example/{i}", page.format(i, "Fine")) for i in range(6)]
    want = "Title {0}\nStory {0} has many words that no other page of the host has, and goes on for some more lines of words.\nMore of {0}."
    assert texts(spark, rows) == {i: want.format(i) for i in range(6)}
    short = (9, "http://h.example/9", page.format(9, "A long and varied set of words that is an").replace(" has many words that no other page of the host has, and goes on for some more lines of words", ""))
    assert texts(spark, [*rows, short])[9] == "Title 9\nStory 9.\nMore of 9."
    assert "offer 9" in texts(spark, [short])[9] and "Printed in town" in texts(spark, [short])[9]


def test_a_page_of_another_kind_keeps_its_text(spark):
    """What does not pair with the content slot is kept where the page has nothing else."""
    rows = [(i, f"http://h.example/{i}", f"<body><div><h1>T {i}</h1><p>Words of page {i} in its place</p></div><p>end {i}</p></body>") for i in range(5)]
    rows.append((7, "http://h.example/7", "<body><table><tr><td>Only this table</td></tr></table></body>"))
    got = texts(spark, rows)
    assert got[7] == "Only this table" and got[3] == "T 3\nWords of page 3 in its place"
