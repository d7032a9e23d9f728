"""The tree of path templates and its purity, grown a second time in plain Python."""

import collections
import random

import pytest

from lotwise.llm import url_filter as u


def grown(rows):
    """(host, shape) to template and purity."""
    n, labelled, blocked = collections.Counter(), collections.Counter(), collections.Counter()
    for host, shape, ruled in rows:
        n[host, shape] += 1
        labelled[host, shape] += ruled is not None
        blocked[host, shape] += ruled == "block"
    template = dict.fromkeys(n, "")
    for level in range(u.DEPTH):
        nodes = collections.defaultdict(lambda: collections.defaultdict(list))
        for path in n:
            steps = path[1].split("/")
            if level < len(steps):
                nodes[path[0], template[path]][steps[level]].append(path)
        for (_, above), kids in nodes.items():
            node_l = sum(labelled[p] for paths in kids.values() for p in paths)
            node_b = sum(blocked[p] for paths in kids.values() for p in paths)
            for step, paths in kids.items():
                l, b = sum(labelled[p] for p in paths), sum(blocked[p] for p in paths)
                apart = (b + 0.5) / (l + 1) - (node_b - b + 0.5) / (node_l - l + 1)
                pooled = (node_b + 1) / (node_l + 2)
                error = pooled * (1 - pooled) * (1 / (l + 1) + 1 / (node_l - l + 1))
                differs = sum(n[p] for p in paths) >= u.SUPPORT and apart**2 > u.APART**2 * error
                for p in paths:
                    template[p] = above + "/" + (step if len(kids) == 1 or differs else u.WILD)
    for path in n:
        if len(path[1].split("/")) > u.DEPTH:
            template[path] += "/" + u.REST
    overall = (sum(blocked.values()) + 1) / (sum(labelled.values()) + 2)

    def share(paths, prior):
        return (sum(blocked[p] for p in paths) + u.PRIOR * prior) / (sum(labelled[p] for p in paths) + u.PRIOR)

    out = {}
    for path in n:
        of_host = [p for p in n if p[0] == path[0]]
        alike = [p for p in of_host if template[p] == template[path]]
        out[path] = template[path], share(alike, share(of_host, overall))
    return out


@pytest.mark.parametrize("labels", [True, False])
def test_tree_equals_a_second_computation(spark, labels):
    r = random.Random(3)
    rows = []
    for _ in range(6000):
        host = r.choice(["hot.org", "hot.org", "a.com", "b.net", ""])
        first = r.choice(["es", "en", "de", "{n}", ""])
        steps = [first, *(r.choice(["x", "y", "{m}", "{x}.html"]) for _ in range(r.choice([0, 1, 2, 2, u.DEPTH + 2])))]
        odds = {"es": 0.95, "en": 0.05, "de": 0.5}.get(first, 0.2)
        ruled = None if r.random() < 0.5 or host == "b.net" else "block" if r.random() < odds else "allow"
        rows.append((host, "/".join(steps), ruled if labels else None))
    urls = spark.createDataFrame(rows, "host string, shape string, ruled string")
    got = {(x["host"], x["shape"]): (x["template"], x["purity"]) for x in u.templates(urls).collect()}
    want = grown(rows)
    assert got.keys() == want.keys()
    for path, (template, purity) in want.items():
        assert got[path] == (template, pytest.approx(purity)), path
    kept = {t for t, _ in want.values()}
    assert any(u.WILD in t for t in kept) and (not labels or any(t.startswith("/es") for t in kept))
