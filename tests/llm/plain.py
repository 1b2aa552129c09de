"""Plain versions that tests compare with."""

import decimal
import math
import re
from collections import defaultdict

import numpy as np

from innkeep.llm.components import roots

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(v):
    v = float(v) if isinstance(v, decimal.Decimal) else v
    return round(v, 5) + 0.0 if isinstance(v, float) else v


def shingles(text: str | None, n: int) -> set:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def links_of(sets: dict[int, set], num: int, den: int) -> dict[int, int]:
    """The component of each set, from all pairs."""
    ids = sorted(sets)
    pairs = [(a, b) for a in range(len(ids)) for b in range(a) if sets[ids[a]] and den * (i := len(sets[ids[a]] & sets[ids[b]])) >= num * (len(sets[ids[a]]) + len(sets[ids[b]]) - i)]
    root = roots(len(ids), np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int))
    return {x: ids[root[k]] for k, x in enumerate(ids)}


_KINDS = [
    (r"[0-9]+", "<num>"),
    (r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "<date>"),
    (r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "<uuid>"),
    (r"[0-9a-f]*[0-9][0-9a-f]*", "<hex>"),
    (r"[0-9]+\.[a-z0-9]{1,5}", "<num>.<ext>"),
]


def _apart(l1, b1, l2, b2):
    if not l1 or not l2 or b1 + b2 in (0, l1 + l2):
        return False
    p = (b1 + b2) / (l1 + l2)
    return abs(b1 / l1 - b2 / l2) >= 1.96 * math.sqrt(p * (1 - p) * (1 / l1 + 1 / l2))


class _Node:
    """A branch of the tree of one host: its paths [(segments left, urls, labels, bad labels, key)]."""

    def __init__(self, paths):
        self.kids, self.key = [], None
        self.n, self.lab, self.bad = (sum(p[i] for p in paths) for i in (1, 2, 3))
        self.paths = paths

    def grow(self):
        by = defaultdict(list)
        for p in self.paths:
            by[p[0][0]].append((p[0][1:], *p[1:]))
        named = defaultdict(list)
        for name, paths in by.items():
            n, lab, bad = (sum(p[i] for p in paths) for i in (1, 2, 3))
            rare = name != "" and len(by) > 12 and n < 0.05 * self.n and not _apart(lab, bad, self.lab - lab, self.bad - bad)
            named["<var>" if rare else name] += paths
        for name, paths in named.items():
            kid = _Node(paths)
            self.kids.append((name, kid))
            if name == "":
                kid.one = True
            elif len(paths) > 1 or name == "<var>":
                kid.grow()
            else:
                leaf = _Node(paths)
                leaf.one = True
                kid.kids = [("/".join(paths[0][0]), leaf)]
                kid.join()
        self.join()

    def join(self):
        pools = defaultdict(list)
        for _, kid in self.kids:
            kid.family = None
            if kid.one and kid.lab:
                pools[kid.bad * 1000 // kid.lab].append(kid)
        families = []
        for _, pool in sorted(pools.items()):
            lab, bad = sum(k.lab for k in pool), sum(k.bad for k in pool)
            if not families or _apart(families[-1][0], families[-1][1], lab, bad):
                families.append([0, 0])
            families[-1][0] += lab
            families[-1][1] += bad
            for kid in pool:
                kid.family = families[-1]
        self.one = all(k.one for _, k in self.kids) and len(families) <= 1

    def share(self, s, p, prefix, out):
        """s: this node's smoothed share; p: the purity of the branch it is part of, if it is all one."""
        if not self.kids:
            for x in self.paths:
                out[x[4]] = ("/" + "/".join(prefix).removesuffix("/"), p)
        for name, kid in self.kids:
            q = p
            if q is None and kid.one:
                q = (kid.family[1] + 4 * s) / (kid.family[0] + 4) if kid.family else s
            kid.share((kid.bad + 4 * s) / (kid.lab + 4), q, [*prefix, name], out)


def url_templates(urls: dict, labels: list[tuple]) -> dict:
    """(host, path, template, share) of each url id, from trees of nodes."""
    worst = {}
    for i, bad in labels:
        if bad is not None:
            worst[i] = max(bad, worst.get(i, 0))
    parsed, paths = {}, {}
    for i, url in urls.items():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].translate(_LOWER), m[2]) if m else ("", "")
        bare = re.sub(r"/+\Z", "", path)
        segments = [next((k for p, k in _KINDS if re.fullmatch(p, x)), x) for x in bare.split("/")[1:]] + [""]
        key = (host, *segments)
        parsed[i] = (host, path, key)
        n, lab, bad = paths.get(key, (0, 0, 0))
        paths[key] = (n + 1, lab + (i in worst), bad + worst.get(i, 0))
    hosts = defaultdict(list)
    for key, sums in paths.items():
        hosts[key[0]].append((key[1:], *sums, key))
    lab, bad = sum(s[1] for s in paths.values()), sum(s[2] for s in paths.values())
    out: dict = {}
    for listed in hosts.values():
        root = _Node(listed)
        root.grow()
        s = (root.bad + 4 * (bad + 1) / (lab + 2)) / (root.lab + 4)
        root.share(s, s if root.one else None, [], out)
    return {i: (host, path, *out[key]) for i, (host, path, key) in parsed.items()}
