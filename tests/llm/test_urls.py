from pointlake.llm import url_templates as U


def _judge(spark, urls, rules=U.RULES):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    return {r.page_id: r for r in U.judge_urls(pages, rules).collect()}


def test_parts_and_rules(spark):
    urls = ["https://A.Example.NET/en/1?x#y", "http://b.net/x", "http://b.net", "http://example.com/de/7", "http://x.example.com/deep/1",
            "http://notnet/x", "http://k.org/fr/", None, "no scheme/net/", "ftp://a.org?q=/fr/", "http://a.net/1://b.org/fr/"]
    got = _judge(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(len(urls))] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("b.net", "/x", "net/"), ("b.net", "", None),
        ("example.com", "/de/7", "example.com/de/"), ("x.example.com", "/deep/1", None), ("notnet", "/x", None),
        ("k.org", "/fr/", "org/fr/"), ("", "", None), ("", "", None), ("a.org", "", None), ("a.net", "/1://b.org/fr/", "net/")]
    assert got[0].verdict == "allow" and got[1].verdict == "block" and got[3].verdict == "block" and got[6].verdict == "allow"


def test_rejected_template_needs_mostly_blocked_labels(spark):
    rules = (("block", "h.com/a/1"), ("allow", "h.com/b/"))
    bad = [f"http://h.com/a/1{i}" for i in range(40)]
    odd = ["http://h.com/a/7"]           # same template as 40 blocked urls
    fine = [f"http://h.com/c/z{i}" for i in range(30)]
    got = _judge(spark, bad + odd + fine + ["http://h.com/b/1"] * 3, rules)
    assert got[40].rule is None and got[40].verdict == "block"
    assert all(got[i].verdict == "allow" for i in range(41, 74))


def test_variable_segments_become_wildcards(spark):
    names = "alpha bravo charlie delta echo foxtrot golf hotel india juliet".split()
    got = _judge(spark, [f"http://h.com/user/{n}/home" for n in names] + ["http://h.com/user/1234/home", "http://h.com/p/0123456789abcdef01/9"])
    assert {got[i].template for i in range(10)} == {"/~/*/home"}  # the lone other branch is too small to tell apart
    assert got[10].template == "/~/#/home" and got[11].template == "/~/@/#"


def test_deep_paths_share_their_tail(spark):
    got = _judge(spark, ["http://h.com/a/b/c/d/e", "http://h.com/a/b/c/x"])
    assert got[0].template == got[1].template == "/a/b/c/**"


def test_empty_and_repeated(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(pages).count() == 0
    got = _judge(spark, ["http://a.com/x"] * 3 + [None] * 2)
    assert len(got) == 5 and {r.verdict for r in got.values()} == {"allow"}


def test_unlabelled_urls_do_not_dilute_the_labels_of_their_template(spark):
    rules = (("block", "h.com/a/1"), ("block", "h.com/user/u1/"), ("allow", "k.com/b/"))
    bad = [f"http://h.com/a/1{i}" for i in range(100)]
    odd = [f"http://h.com/a/2{i}" for i in range(30)]              # the template of 100 blocked urls
    few = ["http://h.com/few/1"] * 3
    users = [f"http://h.com/user/{c}x/home" for c in "abcdefghijklmnopqrstuvwxyz"] + ["http://h.com/user/u1/home"] * 15
    side = [f"http://h.com/c/{i}" for i in range(50)]              # like /a/#, but without labels
    got = _judge(spark, bad + odd + few + users + side, (*rules, ("block", "h.com/few/1")))
    assert all(got[i].rule is None and got[i].verdict == "block" for i in range(100, 130))
    assert all(got[i].verdict == "allow" for i in range(133, 159))  # a blocked user is not all users
    assert all(got[i].verdict == "allow" for i in range(174, 224))


def test_tree_is_built_level_by_level_to_its_end(spark):
    bad = [f"http://h.com/blog/2024/05/casino/win/{i}/x" for i in range(40)]
    side = ["http://h.com/blog/2024/05/recipes/y"]
    below = [f"http://k.com/a/{name}/{i}" for name in "xy" for i in range(30)]
    pairs = [f"http://m.com/{name}" for name in ("p/t", "q/t", "r/u", "s/u") for _ in range(40)]
    got = _judge(spark, bad + side + below + pairs, (("block", "h.com/blog/2024/05/casino/"),))
    assert got[0].template == "/blog/#/#/casino/**" and got[40].template == "/blog/#/#/recipes/**"
    assert got[0].verdict == "block" and got[40].rule is None and got[40].verdict == "allow"
    assert {got[i].template for i in range(41, 101)} == {"/a/~/#"}
    assert {got[i].template for i in range(101, 181)} == {"/~?none?p/t"}  # like each other, not like the pool of all four
    assert {got[i].template for i in range(181, 261)} == {"/~?none?r/u"}
