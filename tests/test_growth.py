"""Steps that must not put a growing table into one process or try every pair."""

import glob

from pyspark.sql import functions as F

from regstar.operators import resolve as M
from regstar.operators.keys import KeyRegistry
from regstar.plans import queries as Q
from regstar.session import ensure_checkpoint_dir, materialize, scratch_path
from regstar.sources.fixtures import dirty_registrations

from conftest import SF_SMALL


def local(path: str) -> str:
    return path.removeprefix("file:")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_keys(spark, n=1500, step=3):
    spell = str.maketrans("0123456789", "abcdefghij")
    names = [(f"blue{m}", str(i * step + 100000).translate(spell) + e) for m in ("anvil", "rod") for i in range(n) for e in ("lxi12", "vxi")]
    dim = spark.createDataFrame([(m, v, i) for i, (m, v) in enumerate(names)], "MODEL_NAME string, VARIANT string, VEHICLE_KEY int")
    recs = spark.createDataFrame([(m, v + "o") for m, v in names if v.endswith("vxi")][::20], "m string, v string")
    return M.match_keys(recs, "m", "v").select("KEY", "BLOCK").distinct(), M.dim_keys(dim)


def test_halves_try_few_pairs_and_lose_none(spark):
    keys, dk = hot_keys(spark, step=599)
    tried = M._half_pairs(keys, dk, 3).distinct().count()
    assert tried < keys.count() * dk.count() / 10  # the common ending alone pairs about half of them
    assert ({tuple(r) for r in M.candidate_pairs(keys, dk, hot_block=0).collect()}
            == {tuple(r) for r in M.candidate_pairs(keys, dk, hot_block=None).collect()})


def test_any_cut_is_exact(spark):
    keys, dk = hot_keys(spark, n=150, step=1)
    band = {tuple(r) for r in M.candidate_pairs(keys, dk, hot_block=None).collect()}
    for sample in (1, 7):  # a judgement by few keys moves the cut only
        pairs = M._half_pairs(keys, dk, 3, sample).distinct()
        assert {r[:3] for r in band} <= {tuple(r) for r in pairs.collect()}


def test_no_growing_table_is_broadcast(spark, tmp_path):
    assert "BroadcastHashJoin" not in plan(dirty_registrations(spark, SF_SMALL))
    keys, dk = hot_keys(spark, n=20)
    keys, dk = materialize(keys, "keys"), materialize(dk, "dk")
    assert "BroadcastHashJoin" not in plan(M.unresolved_keys(keys, dk))
    assert "BroadcastHashJoin" not in plan(M.exact_matches(keys, dk))


def test_registry_join_is_not_broadcast(spark):
    names = materialize(spark.createDataFrame([(f"n{i}",) for i in range(50)], "n string"), "names")
    path = scratch_path(spark, "registry")
    KeyRegistry(spark, path, 0).keyed(names.limit(30), ["n"], "k")
    keyed = KeyRegistry(spark, path, 1).keyed(names, ["n"], "k")
    assert "BroadcastHashJoin" not in plan(keyed)
    assert sorted(r.k for r in keyed.collect()) == list(range(1, 51))


def test_silver_batches_are_many_files(spark):
    ensure_checkpoint_dir(spark)
    base = local(ensure_checkpoint_dir(spark))
    before = set(glob.glob(f"{base}/bronze-files-*/*.parquet"))
    assert Q.QUERIES["silver_incremental"](spark, SF_SMALL).count() > 0
    assert len(set(glob.glob(f"{base}/bronze-files-*/*.parquet")) - before) == 32  # 3 x 8, then 8


def test_malformed_folders_have_several_files(spark):
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        path = local(Q._write_malformed_csv(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
    files = glob.glob(f"{path}/file=*/piece=*/*.txt")
    assert len(files) == 32
    heads = [open(f).readline().strip() for f in files]
    assert set(heads) == {",".join(Q.R.GOLDEN_COLUMNS)}


def test_most_keys_of_unlike_letters_go_no_further(spark):
    codes = [str(i * 599 + 100000).translate(str.maketrans("0123456789", "abcdefghij")) for i in range(200)]
    dim = spark.createDataFrame([(m, c + "lxi12", k) for k, (m, c) in enumerate((m, c) for m in ("blueanvil", "bluesturkmoq") for c in codes)],
                                "MODEL_NAME string, VARIANT string, VEHICLE_KEY int")
    recs = spark.createDataFrame([("blueanvil", c + "lxi1") for c in codes], "m string, v string")
    keys, dk = M.match_keys(recs, "m", "v").select("KEY", "BLOCK").distinct(), M.dim_keys(dim)
    pairs = M._half_pairs(keys, dk, 3)
    assert pairs.filter("KEY2 LIKE 'bluesturkmoq%'").count() < 150  # 326 have like ends; letters that share a bit let some pass
    assert ({tuple(r) for r in M.candidate_pairs(keys, dk, hot_block=0).collect()}
            == {tuple(r) for r in M.candidate_pairs(keys, dk, hot_block=None).collect()})


def test_letters_differ_by_two_an_edit(spark):
    texts = spark.createDataFrame([("abcabc", "abcabc"), ("abcabc", "abcab"), ("aab", "aaab"), ("kitten", "sitting"), ("", "xyz"), ("é𝄞a", "éa")], "a string, b string")
    far = texts.selectExpr("a", "b", "levenshtein(a, b) AS d").withColumns({"x": M._letters(F.col("a")), "y": M._letters(F.col("b"))})
    assert far.filter("bit_count(x ^ y) > 2 * d").count() == 0
