import itertools
import random

from conftest import rows

from locusframe.operators import haplotypes, matching, variants
from locusframe.plans import benchmark
from locusframe.sources.fasta import chunks

VARIANT = "row_id string, contig string, pos long, ref string, alts array<string>, gt string"


def reference():
    """500 bases that hold the expected answers: an A at each called site and a run of 20 A behind 290."""
    draw = random.Random(500)
    run = "C" + 20 * "A" + "C"
    called = {p for p, ref, *_ in [*TRUTH, *QUERY] if ref == "A" and not 290 <= p <= 311}
    bases = ("A" if p in called else run[p - 290] if 290 <= p <= 311 else draw.choice("ACGT") for p in range(1, 501))
    return "".join(bases)


def chunk_table(spark, text, contig="m"):
    lines = [(contig, i, text[i : i + 60]) for i in range(0, len(text), 60)]
    return chunks(spark.createDataFrame(lines, "contig string, start long, bases string"), 64)


def records(spark, items):
    return spark.createDataFrame([(f"v{i}", "m", p, r, a.split(","), g) for i, (p, r, a, g) in enumerate(items)], VARIANT)


# Calls whose expected answers are known.
TRUTH = [(20, "A", "C", "0/1"), (60, "A", "G", "1/1"), (100, "A", "C,G", "1/2"), (150, "A", "C", "0/1"), (200, "A", "T", "0/1"), (291, "A", "AA", "0/1")]
QUERY = [(20, "A", "C", "0/1"), (60, "A", "G", "1/1"), (100, "A", "C", "0/1"), (100, "A", "G", "0/1"), (150, "A", "C", "1/1"), (250, "A", "T", "0/1"), (300, "A", "AA", "0/1"), (400, "A", "T", "0/1")]


def test_benchmark_golden(spark, monkeypatch):
    monkeypatch.setattr(benchmark.variants, "CHUNK", 64)
    text = reference()
    # The plan reads whole chunks of the default width here.
    table = chunks(spark.createDataFrame([("m", 0, text)], "contig string, start long, bases string"))
    query, truth = (benchmark.normalize(records(spark, x), table) for x in (QUERY, TRUTH))
    assert ("m", 290, "C", "CA") in rows(query, "contig", "pos", "ref", "alt")
    assert ("m", 290, "C", "CA") in rows(truth, "contig", "pos", "ref", "alt")
    bed = spark.createDataFrame([("m", 0, 500)], "contig string, start long, end long")
    confident = spark.createDataFrame([("m", 0, 350)], "contig string, start long, end long")
    scored = benchmark.benchmark(query, truth, bed, confident)
    assert rows(scored, "variant_class", "tp_query", "tp_truth", "fp", "fn") == [
        ("INDEL", 1, 1, 0, 0), ("OTHER", 0, 0, 0, 0), ("SNP", 4, 4, 2, 2),
    ]
    empty = benchmark.benchmark(query, truth, bed, confident.filter("false"))
    assert {r.missing_reasons["f1"] for r in empty.collect()} == {"empty_domain"}


def test_metrics_and_reasons(spark):
    counts = spark.createDataFrame([(1, 0, 0, 1, 1), (2, 0, 0, 0, 0), (3, 3, 2, 2, 1)], "id int, tp_query long, tp_truth long, fp long, fn long")
    got = {r.id: r for r in matching.metrics(counts).collect()}
    assert got[1].f1 == 0 and got[2].f1 is None and got[2].precision is None
    assert got[2].missing_reasons == {
        "precision": "zero_query_denominator", "recall": "zero_truth_denominator", "f1": "undefined_precision_or_recall",
    }
    assert got[3].precision == 3 / 5 and got[3].recall == 2 / 3


def test_inclusion_priority(spark):
    df = records(spark, [(1, "A", "C", "0/0"), (2, "A", "C", "./1"), (3, "A", "C", "1"), (4, "A", "C", "0|1"), (5, "A", "C", ".")])
    got = dict(rows(variants.with_inclusion(df), "pos", "reason"))
    assert got == {1: "reference_genotype", 2: "missing_genotype", 3: "non_diploid", 4: None, 5: "missing_genotype"}


def slow_left_align(text, pos, ref, alt):
    """Textbook loop: drop equal last bases, extend left when an allele empties, then trim left."""
    while True:
        if ref and alt and ref[-1] == alt[-1] and (len(ref) > 1 or len(alt) > 1) and not (pos == 1 and min(len(ref), len(alt)) == 1):
            ref, alt = ref[:-1], alt[:-1]
            if not ref or not alt:
                pos -= 1
                ref, alt = text[pos - 1] + ref, text[pos - 1] + alt
        else:
            break
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


def test_left_alignment_equals_the_textbook_loop(spark):
    rng = random.Random(5)
    text = "G" + "".join(rng.choice(["A", "AC", "ACA", "T"]) * rng.randint(1, 6) for _ in range(120)) + "CT" * 90 + "G"
    items = []
    for _ in range(150):
        p = rng.randint(5, len(text) - 12)
        if rng.random() < 0.5:
            items.append((p, text[p - 1 : p + rng.randint(1, 4)], text[p - 1], "0/1"))
        else:
            n = rng.randint(1, 4)
            items.append((p, text[p - 1], text[p - 1] + text[p : p + n], "0/1"))
        items.append((p, text[p - 1 : p + 2], text[p - 1] + rng.choice("ACGT") + rng.choice("ACGT"), "0/1"))
    items.append((len(text) - 1, "T", "TCT", "0/1"))
    items = [x for x in items if x[1] != x[2]]
    split = variants.split_alleles(records(spark, items))
    got = variants.left_align(split, chunk_table(spark, text), "row_id", lookback=16, size=64)
    seen = {r.row_id: (r.pos, r.ref, r.alt) for r in got.collect()}
    assert len(seen) == len(items)
    for i, (p, r, a, _) in enumerate(items):
        assert seen[f"v{i}"] == slow_left_align(text, p, r, a), (i, p, r, a)


def test_reference_mismatch_and_off_reference(spark):
    text = "ACGT" * 40
    df = records(spark, [(1, "ACG", "A", "0/1"), (2, "A", "C", "0/1"), (159, "GTA", "G", "0/1"), (64, "TAC", "T", "0/1")])
    bad = variants.reference_mismatches(df, chunk_table(spark, text), "row_id", 64)
    assert rows(bad, "pos") == [(2,), (159,)]


def diplotypes(text, items):
    """All haplotype pairs a set of records can spell."""
    pairs = set()
    choices = [[(0,), (1,)] if c == 1 else [(0, 1)] for *_, c in items]
    for phase in itertools.product(*choices):
        haps = []
        for h in (0, 1):
            out, at, ok = "", 0, True
            for (pos, ref, alt, _), on in zip(items, phase):
                if h in on:
                    ok = ok and pos - 1 >= at
                    out += text[at : pos - 1] + alt
                    at = pos - 1 + len(ref)
            haps.append((out + text[at:]) if ok else None)
        if None not in haps:
            pairs.add(tuple(haps))
    return pairs


def best_rescue(text, query, truth):
    """Most records that one consistent selection can keep, by trying all subsets."""
    best = 0
    for q in itertools.product([0, 1], repeat=len(query)):
        for t in itertools.product([0, 1], repeat=len(truth)):
            kept_q = [x for x, k in zip(query, q) if k]
            kept_t = [x for x, k in zip(truth, t) if k]
            if sum(q) + sum(t) > best and diplotypes(text, kept_q) & diplotypes(text, kept_t):
                best = sum(q) + sum(t)
    return best


def test_haplotype_rescue_equals_brute_force(spark):
    rng = random.Random(11)
    text = "".join(rng.choice("AC") for _ in range(1800))
    everything, wanted = [], {}
    for case in range(50):
        base = 10 + case * 35
        sides = {False: [], True: []}
        for truth in (False, True):
            places = sorted(rng.sample(range(base, base + 10), 3))
            for p in places:
                kind = rng.random()
                ref = text[p - 1] if kind < 0.6 else text[p - 1 : p + 1]
                alt = {"A": "C", "C": "A"}[ref[0]] if kind < 0.4 else ref[0] if kind > 0.6 else ref + rng.choice("AC")
                sides[truth].append((p, ref, alt, rng.choice([1, 1, 2])))
        wanted[case] = best_rescue(text, sides[False], sides[True])
        for truth, items in sides.items():
            for i, (p, r, a, c) in enumerate(items):
                everything.append((f"{case}:{truth}:{i}", truth, "m", p, r, a, c))
    df = spark.createDataFrame(everything, "row_id string, truth boolean, contig string, pos long, ref string, alt string, alt_copies int")
    got = haplotypes.rescue(df, chunk_table(spark, text), gap=12, size=64).collect()
    assert len(got) == len(everything)
    for case in wanted:
        kept = sum(r.rescued for r in got if r.row_id.startswith(f"{case}:"))
        assert kept == wanted[case], case


def test_long_deletions_and_rejected_records(spark):
    """A REF longer than a chunk is checked like any other, and nothing leaves without a reason."""
    draw = random.Random(9)
    text = "".join(draw.choice("ACGT") for _ in range(2500))
    table = chunks(spark.createDataFrame([("m", i, text[i : i + 50]) for i in range(0, 2500, 50)], "contig string, start long, bases string"))
    wrong = "T" if text[29] != "T" else "A"
    items = [(100, text[99:800], text[99], "0/1"), (30, wrong, "C" if wrong != "C" else "G", "0/1"), (0, "A", "C", "0/1"), (50, "N", "C", "0/1"), (60, text[59], text[59], "1/1")]
    calls = records(spark, items)
    kept = benchmark.normalize(calls, table).collect()
    assert [r.row_id for r in kept] == ["v0"] and len(kept[0].ref) - len(kept[0].alt) == 700
    assert rows(benchmark.rejected(calls, table), "row_id", "rule") == [("v1", "reference"), ("v2", "position"), ("v3", "ref_alphabet"), ("v4", "alt_equals_ref")]


def test_a_stretch_too_wide_is_told_and_the_next_one_decided(spark):
    """With few states allowed a dense stretch comes back whole with a rule; a lone pair behind it is rescued."""
    text = "ACGT" * 100
    rows = [(f"q{i}", False, "m", 40 + i, text[39 + i : 41 + i], text[39 + i], 1) for i in range(8)]
    rows += [(f"t{i}", True, "m", 40 + i, text[39 + i], text[39 + i] * 2, 1) for i in range(8)]
    rows += [("a", False, "m", 301, text[300:302], "GG", 1), ("b", True, "m", 301, text[300], "G", 1), ("c", True, "m", 302, text[301], "G", 1)]
    df = spark.createDataFrame(rows, "row_id string, truth boolean, contig string, pos long, ref string, alt string, alt_copies int")
    table = chunk_table(spark, text)
    got = {r.row_id: (r.rescued, r.rule) for r in haplotypes.rescue(df, table, gap=300, size=64, most=20).collect()}
    assert all(v == (False, "too_wide") for k, v in got.items() if k not in "abc") and len(got) == 19
    assert all(got[k] == (True, None) for k in "abc")
    free = haplotypes.rescue(df, table, gap=300, size=64).collect()
    assert all(r.rule is None for r in free) and all(r.rescued for r in free if r.row_id in "abc")


def test_one_read_of_the_reference_aligns_like_two(spark):
    rng = random.Random(23)
    text = "".join(rng.choice("AC") * rng.choice([1, 1, 2, 30]) for _ in range(60))
    rows = []
    for i in range(120):
        at, n = rng.randrange(len(text) - 6), rng.randint(1, 4)
        ref = text[at : at + n]
        alt = ref[0] if n > 1 else ref + "".join(rng.choice("AC") for _ in range(rng.randint(1, 3)))
        rows.append((f"v{i}", "m", at + 1, ref, [alt], "0/1"))
    df = spark.createDataFrame(rows, "row_id string, contig string, pos long, ref string, alts array<string>, gt string")
    table = chunk_table(spark, text)
    checked = variants.check_reference(df, table, "row_id", 64, lookback=4).filter("ref_ok").drop("ref_ok")
    one = variants.align_checked(variants.split_alleles(checked), table, "row_id", 4, 64)
    two = variants.left_align(variants.split_alleles(checked.drop("_before")), table, "row_id", 16, 64)
    columns = ["row_id", "contig", "pos", "ref", "alt"]
    assert sorted(map(tuple, one.select(*columns).collect())) == sorted(map(tuple, two.select(*columns).collect()))
    assert one.count() == 120


def test_record_rules_are_planned_once(spark):
    """The filter takes the rule as given instead of working out all rules once more."""
    from locusframe.catalog.adapters import Tables
    from locusframe.catalog.variant_queries import variant_validity

    plan = variant_validity(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("allele_index") == 1


def nested_insertions(n):
    """Insertions of 1, 2, 4 and more letters into a run of A, in truth and again in the calls: every sum of them is a state."""
    sizes = ["A" * (2**i + 1) for i in range(n)]
    return [(f"t{i}", True, "m", 2 + i, "A", a, 1) for i, a in enumerate(sizes)] + [(f"q{i}", False, "m", 2 + n + i, "A", a, 1) for i, a in enumerate(sizes)]


def test_a_stretch_of_very_many_states_is_decided(spark):
    """More than 20,000 states do not leave a stretch undecided."""
    rows = nested_insertions(7)
    df = spark.createDataFrame(rows, "row_id string, truth boolean, contig string, pos long, ref string, alt string, alt_copies int")
    got = haplotypes.rescue(df, chunk_table(spark, "C" + "A" * 60 + "G" * 40), size=64).collect()
    assert len(got) == 14 and all(r.rescued and r.rule is None for r in got)


def test_states_on_disk_are_those_in_memory(monkeypatch):
    """States in runs that were merged several times, and split by the length of their texts, keep as many records."""
    monkeypatch.setattr(haplotypes, "FAN_IN", 3)
    rng = random.Random(5)
    for case in range(60):
        text = "".join(rng.choice("AC") for _ in range(60))
        items = []
        for truth in (False, True):
            for p in rng.sample(range(3, 40), rng.randint(3, 12)):
                ref = text[p - 1 : p + rng.randint(0, 1)]
                alt = rng.choice([ref[0], {"A": "C", "C": "A"}[ref[0]], ref + rng.choice("AC")])
                items.append((f"{truth}{p}", truth, p - 1, ref, alt, rng.choice([1, 1, 2])))
        items.sort(key=lambda r: (r[2], r[1], r[0]))
        found = []
        for held, letters in ((10**6, 10**6), (3, 10**6), (10**6, 20)):
            monkeypatch.setattr(haplotypes, "HELD_LETTERS", letters)
            replay, at = haplotypes.Replay(held=held), 0
            for row_id, truth, start, ref, alt, copies in items:
                replay.feed(row_id, truth, start, ref, alt, copies, text[at:start])
                at = start
            done = replay.finish(text[at : replay.reach])
            assert [d[0] for d in done] == [i[0] for i in items]
            found.append(sum(d[1] for d in done))
        assert found[0] == found[1] == found[2], case
