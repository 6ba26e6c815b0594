"""Matchers of entities against all pairs and plain rules."""

import random
from difflib import SequenceMatcher

import pytest
from gridloom.operators import entities as en


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def catalog(seed, n, letters):
    rng = random.Random(seed)
    names = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(n)})
    values = set()
    for name in names:
        chars = list(name)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(chars) + 1)
            chars[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
        values.add("".join(chars))
    return names, sorted(values)


@pytest.mark.parametrize("mode", ["levenshtein", "ratio"])
@pytest.mark.parametrize("letters", ["abc", "abcdefgh"])
def test_closest_names_equal_all_pairs(spark, mode, letters):
    names, values = catalog(7, 70, letters)
    half = len(names) // 2
    states = [(n, i) for i, n in enumerate(names[:half])]
    aliases = [(a, f"of {a}", i) for i, a in enumerate(names[half:])]
    ratio = en.similarity_ratio if mode == "ratio" else en.levenshtein_ratio
    of = (lambda a, b: SequenceMatcher(None, a, b).ratio()) if mode == "ratio" else (lambda a, b: 1 - levenshtein(a, b) / max(len(a), len(b), 1))
    got = en.match_state(
        spark.createDataFrame([(v,) for v in [*values, "", None]], "value string"),
        spark.createDataFrame(states, "canonical string, priority int"),
        spark.createDataFrame(aliases, "alias string, canonical string, priority int"),
        ratio=ratio,
    )
    want = {"": (None, None), None: (None, None)}
    for v in values:
        key = v.strip()
        best = [(0 if key == n else 2, 0, p, n, "exact") for n, p in states if key == n] + [(1, 1, p, c, "alias") for a, c, p in aliases if key == a]
        if not best:
            best = [(-of(key, n), k, p, c, "fuzzy") for k, side in ((0, [(n, n, p) for n, p in states]), (1, aliases)) for n, c, p in side if key and of(key, n) >= 0.85]
        want[v] = min(best)[3:] if best else (None, None)
    assert {r.value: (r.canonical, r.method) for r in got.collect()} == want


def test_the_fuzzy_step_has_no_nested_loop(spark):
    rng = random.Random(1)
    names = [("".join(rng.choice("abcdefghijklmnop") for _ in range(12)), i) for i in range(2000)]
    values = [(n[:5] + rng.choice("xyz") + n[6:] + str(i % 10),) for n, i in names for _ in range(2)]
    df = en.match_state(spark.createDataFrame(values, "value string"), spark.createDataFrame(names, "canonical string, priority int"), spark.createDataFrame([], "alias string, canonical string, priority int"), least=0.8)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert df.where("method = 'fuzzy'").count() == len({v for (v,) in values})


def test_values_are_read_in_their_context(spark):
    catalog = spark.createDataFrame([("Torrent", 1, "Gujarat"), ("TPL", 2, "Gujarat"), ("BRPL", 1, "Delhi")], "canonical string, priority int, state string")
    states = (spark.createDataFrame([("Gujarat", 1), ("Delhi", 2)], "canonical string, priority int"), spark.createDataFrame([("gj", "Gujarat", 1)], "alias string, canonical string, priority int"))
    triples = [
        ("12", "11 kV Charge", "Delhi"), ("12345", "11 kV Charge", "Delhi"), ("12", "Charge", "Delhi"), ("tp", "Name", "Gujarat"), ("tp", "Name", "Delhi"),
        ("tp", "Name", None), ("GJ", "State", None), ("Gujrat", "", ""), ("West Plant", "Utility", None), ("7.5", "Utility", None), ("Big Shop", "Tariff", None),
        ("2024-25", "11 kV", None), ("5 Rs/kWh", "x", "Delhi"), ("zzz", None, None), ("5 paise", "Charge (Rs/kWh)", None), ("220 V", "", None), ("HT line", "", None),
    ]
    df = spark.createDataFrame(triples, "value string, header string, state string")
    found = en.recognize_in_context(df.union(df), states, catalog, [r"(?i)discom"], {"ht": "HT"}, {"rs/kwh": "Rs/kWh"}, {"shop": "Commercial"})
    got = {(r.value, r.header, r.state): (r.entity_type, r.canonical, r.confidence) for r in found.collect()}
    assert len(got) == len(triples)
    assert got["12", "11 kV Charge", "Delhi"] == ("voltage", "11 kV", 0.7) and got["12345", "11 kV Charge", "Delhi"][0] == "unknown" and got["12", "Charge", "Delhi"][0] == "unknown"
    assert got["tp", "Name", "Gujarat"] == ("utility", "TPL", 0.85) and got["tp", "Name", "Delhi"][0] == "unknown" and got["tp", "Name", ""][0] == "unknown"
    assert got["GJ", "State", ""] == ("state", "Gujarat", 1.0) and got["Gujrat", "", ""][:2] == ("state", "Gujarat")
    assert got["West Plant", "Utility", ""] == ("utility", "West Plant", 0.5) and got["7.5", "Utility", ""][0] == "unknown"
    assert got["Big Shop", "Tariff", ""] == ("category", "Commercial", 0.9) and got["2024-25", "11 kV", ""] == ("year", "2024-25", 1.0)
    assert got["5 Rs/kWh", "x", "Delhi"][:2] == ("unit", "Rs/kWh") and got["5 paise", "Charge (Rs/kWh)", ""] == ("unit", "Rs/kWh", 0.75)
    assert got["220 V", "", ""] == ("voltage", "220 V", 0.9) and got["HT line", "", ""] == ("voltage", "HT", 0.8) and got["zzz", "", ""] == ("unknown", None, 0.0)


@pytest.mark.parametrize("seed", range(4))
def test_header_spans_of_any_depth(spark, seed):
    from gridloom.operators import headers as hd

    rng = random.Random(seed)
    depth, width = rng.randint(1, 8), 7
    grid = [[rng.choice(["", "", "", "a", "b", "-"]) for _ in range(width)] for _ in range(depth)]
    rows = spark.createDataFrame([("r", i + 1, [f" {c} " for c in cells]) for i, cells in enumerate(grid)] + [("r", depth + 1, ["1"] * width)], "report_id string, row_no int, cells array<string>")
    depths = spark.createDataFrame([("r", depth)], "report_id string, depth int")
    for c in range(1, width):
        grid[0][c] = grid[0][c] or grid[0][c - 1]
    for r in range(1, depth):
        for c in range(width):
            grid[r][c] = grid[r][c] or grid[r - 1][c] or (grid[r][c - 1] if c else "")
    got = {(x.row_no, x.col_idx): x.cell for x in hd.fill_header_spans(rows, depths).collect()}
    assert got == {(r + 1, c): grid[r][c] for r in range(depth) for c in range(width)}


def test_annotated_cells_keep_numbers_of_charges_only(spark):
    from gridloom.operators import headers as hd

    rows = spark.createDataFrame([("r", 1, ["State", "S.No", "Rate %", "HT kV", "Charge"]), ("r", 2, ["Delhi", "3", "7", "33", "1.5"]), ("r", 3, ["", "N/A", "-", "x", "nil"]), ("r", 4, [None, "9"])], "report_id string, row_no int, cells array<string>")
    columns = hd.describe_columns(hd.header_paths(hd.fill_header_spans(rows, spark.createDataFrame([("r", 1)], "report_id string, depth int"))))
    assert {r.col_idx: (r.role, r.entity_type) for r in columns.collect()} == {0: ("state", "state"), 1: ("serial_number", "serial_number"), 2: ("value", "percentage"), 3: ("voltage", "voltage"), 4: ("value", "charge")}
    named = lambda v: v.withColumn("canonical", en.F.when(en.F.col("value") == "Delhi", "Delhi"))
    cells = hd.cells_in_context(rows, columns, spark.createDataFrame([("r", 1)], "report_id string, depth int"), named)
    none = spark.createDataFrame([("Delhi", "State", "Delhi", "state", "Delhi", 1.0)], "value string, header string, state string, entity_type string, canonical string, confidence double")
    got = {(r.row_no, r.col_idx): (r.annotation, r.canonical, r.number, r.unit, r.state) for r in hd.annotate_cells(cells, none).collect()}
    assert got[2, 0] == ("state", "Delhi", None, None, "Delhi") and got[2, 1] == ("serial_number", "3", None, None, "Delhi")
    assert got[2, 2] == ("percentage", "7", 7.0, "%", "Delhi") and got[2, 3] == ("voltage", "33 kV", None, None, "Delhi") and got[2, 4] == ("charge", "1.5", 1.5, "Rs/kWh", "Delhi")
    assert got[3, 1][0] == got[3, 2][0] == "empty" and got[3, 3] == ("unknown", "x", None, None, None) and got[1, 0][0] == "header" and got[4, 0][0] == "empty"


def test_short_keys_and_names_of_the_active_state_join_on_pieces(spark):
    from gridloom.operators.entities import match_utility
    from pyspark.sql import functions as F

    catalog = spark.createDataFrame([("Torrent", 3, "GJ"), ("Torus", 1, "GJ"), ("TP", 2, "GJ"), ("Orbit", 0, "DL")], "canonical string, priority int, state string")
    values = spark.createDataFrame([("tor", "GJ"), ("or", "GJ"), ("or", "DL"), ("xtpx", "GJ"), ("xtpx", "DL"), ("q", "GJ"), ("or", None)], "value string, st string")
    frame = match_utility(values, catalog, [], state=F.col("st"))
    got = {(r.value, r.state): (r.canonical, r.method) for r in frame.collect()}
    near = "active_state"
    assert got == {("tor", "GJ"): ("Torus", near), ("or", "GJ"): ("Torus", near), ("or", "DL"): ("Orbit", near), ("xtpx", "GJ"): ("TP", near), ("xtpx", "DL"): (None, None), ("q", "GJ"): (None, None), ("or", None): (None, None)}
    # keys and names of a state are not paired one by one
    assert "Contains(key" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_values_are_recognized_among_all_customers(spark, monkeypatch):
    from gridloom.fixtures import table
    from gridloom.plans import layouts

    seen = []
    real = en.recognize_in_context
    monkeypatch.setattr(layouts.en, "recognize_in_context", lambda triples, states, utilities, *rest: seen.append(utilities) or real(triples, states, utilities, *rest))
    sf = "/root/testdata/sf0.001"
    layouts.g7(spark, sf)
    customers = table(spark, sf, "customer")
    assert sorted(r.canonical for r in seen[0].collect()) == sorted(r.c_name for r in customers.collect())
    # one that was in no catalog: beyond the first, with a key that three does not divide
    value = spark.createDataFrame([("Customer#000000100 Ltd", "Charge", "BUILDING")], "value string, header string, state string")
    got = layouts.recognized(value, spark, sf).first()
    assert (got.entity_type, got.canonical, got.method) == ("utility", "Customer#000000100", "substring")
