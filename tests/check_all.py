"""python tests/check_all.py <sf dir> [query ...]: every query against its SQL, with types and times."""

import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from swipelake import queries as q  # noqa: E402

sf, names = sys.argv[1], sys.argv[2:]
spark = (
    SparkSession.builder.master("local[8]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
con = oracle.connect(sf)
bad = 0
for name, fn in q.queries().items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        sql = q.oracle_sql().get(name)
        if sql is None:
            result = f"rows only: {df.count()}"
        else:
            result = oracle.compare(df, con, sql)
            types = {c: t.simpleString() for c, t in ((f.name, f.dataType) for f in df.schema.fields)}
            duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
            print(f"   {[(c, types[c], duck.get(c)) for c in sorted(types)]}")
        bad += bool(result) and sql is not None
    except Exception as e:  # report and go on
        result, bad = f"{type(e).__name__}: {str(e)[:600]}", bad + 1
    print(f"{name:28s} {time.time() - t:6.2f}s {result or 'ok'}", flush=True)
print("bad", bad)
