import itertools
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.llm.form_copies import carry_over, collapse_copies, joined_alike, vendor_records

SCHEMA = "id string, text string, node string"


def _brute(rows):
    """Components by pairwise test of the definition."""
    rows = [(i.strip(), t) for i, t in rows if i is not None and i.strip() and t is not None and re.sub(r"[\W_]", "", t)]

    def keys(t):
        a = re.sub(r"[^\w\s]|_", "", t.lower()).split()
        b = re.sub(r"[\W_]", " ", t.lower()).split()
        out = {"j" + "".join(b)}
        for w in (a, b):
            out.add(" ".join(sorted(w)))
            out |= {" ".join(sorted([*w[:i], w[i] + w[i + 1], *w[i + 2 :]])) for i in range(len(w) - 1)}
        return out

    label = {i: i for i, _ in rows}
    for _ in rows:
        for (i, s), (j, t) in itertools.combinations(rows, 2):
            if i == j or keys(s) & keys(t):
                label[i] = label[j] = min(label[i], label[j])
    return label


def _mine(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {r.id: r.keep_id for r in collapse_copies(df, "id", "text").collect()}


ROWS = [
    ("5", "O'Hara & Sons, LLC"), ("4", "ohara  sons llc"), ("3", "LLC Sons O Hara"), ("6", "K.T. Steel"), ("7", "K T Steel"), ("8", "steel KT"), ("9", "TK Steel"), ("a", "Yevasell Co"), ("b", "Elvasley Co"),
    ("c", None), ("d", ""), ("e", " - & "), (None, "K.T. Steel"), ("f", "Mid Town"), ("g", "MIDTOWN"), ("h", "x" * 50_000), ("i", "X" * 50_000 + "."), ("5", "O'Hara & Sons, LLC"), (" 6 ", "K.T. Steel"),
]


def test_against_brute_force(spark):
    got = _mine(spark, ROWS)
    assert got == _brute(ROWS)
    assert got["5"] == "3" and got["8"] == "6" and got["9"] == "9" and got["b"] == "b" and got["i"] == "h" and "d" not in got


def test_empty_and_torn_ids(spark):
    assert _mine(spark, []) == {}
    assert _mine(spark, [("1", "alpha"), ("1", "beta"), ("2", "Beta!"), ("0", "ALPHA")]) == {"0": "0", "1": "0", "2": "0"}


def test_one_hot_vendor(spark):
    rows = [(f"{i:05}", ["Hot  Vendor", "vendor, hot", "HOT VENDOR."][i % 3]) for i in range(2000)] + [(f"x{i}", f"cold {i}") for i in range(500)]
    got = _mine(spark, rows)
    assert {v for k, v in got.items() if k[0] != "x"} == {"00000"} and len(got) == 2500


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab &.'", max_size=6), max_size=8))
def test_random_names(spark, names):
    rows = [(str(i), n) for i, n in enumerate(names)]
    assert _mine(spark, rows) == _brute(rows)


def test_several_joined_pairs_and_another_order(spark):
    rows = [("1", "Gulf Coast Steel Works"), ("2", "SteelWorks GulfCoast"), ("3", "Steel Gulf Works Coats"), ("4", "Elk Ridge Tile Mart"), ("5", "tile-mart elkridge"), ("6", "Kelridge Tile Mart")]
    assert _mine(spark, rows) == {"1": "1", "2": "1", "3": "3", "4": "4", "5": "4", "6": "6"}


def test_names_of_any_number_of_words(spark):
    w = "alder birch cedar dogwood elm fir ginkgo hazel iris juniper kapok larch maple nutmeg oak pine quince rowan".split()
    more = [f"{x}{y}" for x in w for y in "xyz"]
    rows = [
        ("1", " ".join(w)), ("2", " ".join([*w[9:], w[0] + w[1], w[2] + w[3] + w[4], *w[5:9]])), ("3", "-".join([w[1] + w[0], *w[2:16], w[17] + w[16]])),
        ("4", "".join(w[:6]) + " " + "".join(w[12:]) + ", " + "".join(w[6:12])),  # three words of eighteen
        ("5", " ".join(more)), ("6", " ".join([*more[30:], *(a + b for a, b in zip(more[:30:2], more[1:30:2], strict=True))])), ("7", " ".join(["la"] * 40 + ["lala"] * 9)), ("8", " ".join(["lalala"] * 6 + ["la"] * 40)),
    ]
    assert _mine(spark, rows) == {"1": "1", "2": "1", "3": "3", "4": "1", "5": "5", "6": "5", "7": "7", "8": "7"}


@settings(max_examples=300, deadline=None)
@given(st.data(), st.lists(st.sampled_from(["a", "b", "ab", "ba", "aab", "c"]), min_size=1, max_size=7))
def test_joined_alike_against_all_ways(data, a):
    def ways(words):
        cuts = itertools.product((" ", ""), repeat=len(words) - 1)
        return {" ".join(sorted("".join(x for p in zip(words, (*c, ""), strict=True) for x in p).split())) for c in cuts}

    b = data.draw(st.permutations(a))
    b = "".join(x for w in b for x in (w, data.draw(st.sampled_from((" ", ""))))).split()
    assert joined_alike(tuple(a), tuple(b)) == bool(ways(a) & ways(b))


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    took = {}
    for n in (8, 64, 512):
        order = sorted(range(n), key=lambda i: (i * 7919) % n)
        edges = [(f"{order[i]:05}", f"k{i}") for i in range(n)] + [(f"{order[i]:05}", f"k{i - 1}") for i in range(1, n)]
        rounds = []
        got = carry_over(spark.createDataFrame(edges, "node string, key string"), rounds).collect()
        assert len(got) == n and {r.label for r in got} == {"00000"}
        took[n] = rounds[0]
    assert took[512] <= took[8] + 8, took


def test_records_carry_the_kept_name(spark):
    v = spark.createDataFrame([("2", "K.T. Steel"), ("5", "kt steel"), ("3", "Other"), ("4", None)], "vendor_id string, vendor_name string")
    q = spark.createDataFrame([("1", "STEEL, K T"), ("1", "steel k.t.")], "qbo_vendor_id string, vendor_name string")
    assert {tuple(r) for r in vendor_records(v, q).collect()} == {("1", "STEEL, K T", 3), ("3", "Other", 1)}
