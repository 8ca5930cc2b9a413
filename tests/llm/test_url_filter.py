import math
import random
from collections import Counter

from pyspark.sql import functions as F

from ratewise.llm.url_filter import Markov, _grams, judge

URLS = [(1, "http://A.example.org/es/1"), (2, "https://example.org/en/12"), (3, "http://x.org/en/1"), (4, "http://b.com/fr/1?x=/"),
        (5, "http://b.com/de/1#t"), (6, "http://org"), (7, None), (8, "no scheme"), (9, ""), (10, "http://b.net/fr/3"), (10, "http://b.net/fr/3"),
        (None, "http://notexample.org.net/es/"), (11, "http://example.com/" + "x" * 50_000)]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, "extra") for i, u in URLS], "page_id long, url string, rule string")
    got = {(r["page_id"], r["host"][:20], r["path"][:8], r["rule"]): r["verdict"] for r in judge(df).collect()}
    assert got[1, "a.example.org", "/es/1", "example.org/es/"] == "block"
    assert got[2, "example.org", "/en/12", "example.org/en/1"] == "block"
    assert got[3, "x.org", "/en/1", "org/"] == "allow"
    assert got[4, "b.com", "/fr/1", "com/fr/"] == "allow" and got[5, "b.com", "/de/1", "com/de/"] == "block"
    assert (6, "org", "", None) in got and (7, "", "", None) in got and (8, "", "", None) in got
    assert (None, "notexample.org.net", "/es/", None) in got
    assert judge(df).count() == len(URLS) and judge(df.filter(F.lit(False))).count() == 0


def test_probabilities_are_smoothed():
    m = Markov(["a", "b", "aa", "ab"], [3, 1, 2, 1])
    assert 0 < m.probability("z") < m.probability("b") < m.probability("a") < 1


def test_rare_ngrams_count_in_a_large_table(spark):
    """Over 500,000 positions, where n-grams seen once were dropped: scores equal a model of all of them."""
    r = random.Random(3)
    words = ["news", "shop", "cat", "blog", "item", "été"]

    def url(top, path):
        return f"http://{r.choice(words)}{r.randrange(60)}.{top}/{path}/{r.choice(words)}-{r.randrange(300)}"

    urls = [url("com", "fr") for _ in range(14_000)] + [url("com", "de") for _ in range(6_000)]
    urls += ["http://qzx.com/de/zzqqj", "http://vwk.com/fr/jjkkw"] + [f"http://a.net/{w}/{x}" for w in words for x in ("zzqqj", "jjkkw", "7")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    got = {x["page_id"]: x["score"] for x in judge(df).collect()}
    assert len(got) == len(urls)
    train = [x["url"] for x in df.filter(F.pmod(F.xxhash64("url"), F.lit(10)) != 0).select("url").collect()]
    counts = {p: Counter(g for u in train if f".com/{p}/" in u for g in _grams(u)) for p in ("fr", "de")}
    assert sum(len(u) + 1 for u in train) > 500_000
    accepted, rejected = (Markov(list(c), list(c.values())) for c in (counts["fr"], counts["de"]))
    for k, u in enumerate(urls):
        if ".net/" not in u:
            assert got[k] is None
            continue
        longest = [g for g in _grams(u) if len(g) == 6]
        want = sum(math.log(accepted.probability(g) / rejected.probability(g)) for g in longest) / (len(u) + 1)
        assert abs(got[k] - want) < 1e-9
