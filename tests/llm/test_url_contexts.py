"""The URL filter's model over real characters with long contexts."""

import hashlib
import math
from collections import Counter

from kvflow.llm import urlfilter


def test_deep_contexts(spark):
    rules = (("allow", "a.org/en/2"), ("block", "a.org/en/1"), ("allow", "a.org/дом"), ("block", "a.org/кот"))
    ruled = [f"https://a.org/en/{d}{i:02}" for d in (1, 2) for i in range(30)] + [f"https://a.org/{w}{i}" for w in ("дом", "кот") for i in range(9)]
    free = ["https://b.org/en/155", "https://b.org/en/255", "https://b.org/кот5", "https://b.org/дом5"]
    urls = ruled + free + [None, "", "nothing", "http://", free[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.judge(pages, rules=rules).collect()}
    assert len(got) == len(urls)
    scores = [got[len(ruled) + i].score for i in range(4)]
    assert scores[0] < 0 < scores[1] and scores[2] < 0 < scores[3] and got[len(urls) - 1][1:] == got[len(ruled)][1:]
    assert [got[len(ruled) + i].verdict for i in (0, 2, 4, 5, 6)] == ["block"] * 5

    n, all_ = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
    for i, u in enumerate(ruled):
        if hashlib.md5(u.encode()).hexdigest() < urlfilter.HELD_OUT:
            continue
        s = "\x02" + u.partition("://")[2]
        for k in range(1, len(s)):
            for j in range(max(0, k - urlfilter.ORDER), k + 1):
                n[got[i].verdict == "allow"][s[j : k + 1]] += 1
                all_[got[i].verdict == "allow"][s[j:k]] += 1
    kinds = len({g for y in n.values() for g in y if len(g) == 1}) + 1

    def log_chance(s, k, yes):
        p = 1 / kinds
        for j in range(k, max(0, k - urlfilter.ORDER) - 1, -1):
            p = (n[yes][s[j : k + 1]] + urlfilter.BACKOFF * p) / (all_[yes][s[j:k]] + urlfilter.BACKOFF)
        return math.log(p)

    for i in (0, 40, 63, 75, len(ruled), len(ruled) + 3):
        s = "\x02" + urls[i].partition("://")[2]
        want = sum(log_chance(s, k, True) - log_chance(s, k, False) for k in range(1, len(s))) / (len(s) - 1)
        assert math.isclose(got[i].score, want, abs_tol=1e-8), urls[i]
    assert urlfilter.judge(pages.limit(0)).count() == 0
