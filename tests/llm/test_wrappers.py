"""Wrappers are learned from all pages of a host, not from some."""

from pricelens.llm import wrappers


def test_every_structure_of_a_host_is_learned(spark):
    page = lambda i: f"<body><h2>Notice</h2><p>story {i}</p><div class=x{i}><p>more {i}</p></div></body>"
    df = spark.createDataFrame([(i, "http://h/a", page(i)) for i in range(40)], "page_id long, url string, html string")
    for at_once in (3, 64):
        got = {r["page_id"]: r["text"] for r in wrappers.extract(df, sample=at_once).collect()}
        assert got == {i: f"story {i}\nmore {i}" for i in range(40)}


def test_slots_that_stand_elsewhere_are_no_match():
    wrapper = wrappers.infer(["<body><p>a</p><article><p>b</p></article></body>"])
    labels, _, places = wrappers.page_tokens("<body><p>a</p><article><p>b</p></article></body>")
    assert len(wrappers.matched(wrapper, labels, places)) == 2
    assert wrappers.matched(wrapper, labels, places[::-1]) is None


def test_a_wrapper_stays_bounded(monkeypatch):
    monkeypatch.setattr(wrappers, "MOST_NODES", 12)
    pages = [[f"div class={i}", ["#", "", []], "p", ["#", "", []]] for i in range(9)]
    assert wrappers.size_of(wrappers.joined(pages)) <= 12


def test_structures_beyond_the_bound_are_learned_too(spark):
    # No two structures of 2,100 nodes fit into one wrapper.  Only a wrapper knows that a notice without a name is the same on all its pages.
    def page(k, i):
        rules = "".join(f"<hr class=z{k}-{j}>" for j in range(2_095))
        return f"<body class=x{k}><h2 class=n{k}>Notice {k}</h2><p class=y{k}>story {k} {i}</p>{rules}</body>"

    several = wrappers.all_joined([(k, [f"hr class={k}-{j}" for j in range(1_500)]) for k in range(4)])
    assert [d for d, _ in several] == [0, 2] and all(wrappers.size_of(w) <= wrappers.MOST_NODES for _, w in several)
    df = spark.createDataFrame([(10 * k + i, "http://h/a", page(k, i)) for k in range(4) for i in range(4)], "page_id long, url string, html string")
    for at_once in (2, 64):
        got = {r["page_id"]: r["text"] for r in wrappers.extract(df, sample=at_once).collect()}
        assert got == {10 * k + i: f"story {k} {i}" for k in range(4) for i in range(4)}
