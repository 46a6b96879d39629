"""Rows from a catalogue of actors: what comes in, what is made, what goes out."""

from kilnspark.operators import clusters as U

SCHEMA = f"type string, values {U.VALUES}"
GOOD = [("Bear", "u1", (["Cozy Bear", " cozy bear", "AB", "bear", "Du\x07kes", "The Dukes", None][:6], "ru")), ("Panda", "u2", (["Red", "The Dukes"], None)), ("Kitten", "u3", (None, "XX")), ("Crane", "u4", None)]


def bundle(spark, values, kind="actors"):
    return spark.createDataFrame([(kind, values)], SCHEMA)


def test_faults_of_a_catalogue(spark):
    assert U.cluster_faults(bundle(spark, GOOD), "actors").collect() == []
    bad = [(" ", "u1", None), ("A", None, (["ok", None], None)), ("B", "u3", None)]
    assert {tuple(r) for r in U.cluster_faults(bundle(spark, bad, "tools"), "actors").collect()} == {(-1, "type"), (0, "value"), (1, "uuid"), (1, "synonyms")}
    assert {tuple(r) for r in U.cluster_faults(bundle(spark, []), "actors").collect()} == {(-1, "values")}


def test_rows_and_their_checks(spark):
    known = U.actors(bundle(spark, GOOD), {"RU": "Russia"})
    assert {r.uuid: (r.synonyms, r.country) for r in known.collect()} == {"u1": (["Cozy Bear", "The Dukes"], "Russia"), "u2": (["Red", "The Dukes"], ""), "u3": ([], "XX"), "u4": ([], "")}
    subsets = [(r.input, r.output) for r in U.subset_rows(known, "s").collect()]
    assert len(subsets) == len(set(subsets)) == 6 and all("{" not in x for x, _ in subsets)
    cards = {r.uuid: r.output for r in U.card_rows(known, "s").collect()}
    assert cards == {"u1": "Name: Bear. Country: Russia. Synonyms: Cozy Bear, The Dukes.", "u2": "Name: Panda. Country: not documented. Synonyms: Red, The Dukes."}
    claims = U.rejection_rows(known, "s").collect()
    # The Dukes is claimed by two; each other alias meets every other actor
    assert len(claims) == 6 and not any("Dukes" in r.input for r in claims) and {r.uuid for r in claims} == {"u1", "u2"}
    assert all(r.output.startswith("Reject.") and r.output.endswith({"u1": "Bear.", "u2": "Panda."}[r.uuid]) for r in claims)
    rows = spark.createDataFrame([(1, "a", "b", "CANON.1"), (2, "a", "b", "CANON.1"), (3, " ", "b", "CANON.9"), (4, "ab", "", "CANON.2"), (5, None, "x", None)], "k int, input string, output string, shortname string")
    assert {tuple(r) for r in U.row_faults(rows, "k", r"^CANON\.[123]$").collect()} == {(2, "again"), (3, "input"), (3, "pattern"), (4, "output"), (5, "input"), (5, "shortname"), (5, "pattern")}
