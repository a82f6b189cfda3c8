import os

from gridpulse.plans.jobs import Inputs
from gridpulse.streaming.incremental import run_incremental


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_incremental_reruns_touched_days(spark, tmpdir_path):
    root = tmpdir_path
    maps, feeds_root, out = f"{root}/maps", f"{root}/feeds", f"{root}/out"
    _write(f"{maps}/GA/col_map.csv", "raw,standard\nname,county\nn_out,per_outage_customers_affected\n"
                                      "cust_s,customers_served\ntimestamp,timestamp\n")
    _write(f"{maps}/GA/county_map.csv", "raw,standard,score\nfulton,fulton,100\ncobb,cobb,100\n")
    _write(f"{maps}/GA/master_county_list.txt", "Fulton County\nCobb County\n")
    _write(f"{root}/fips.csv", "state_abbr,state_name,county_name,fips\nGA,georgia,fulton,13121\nGA,georgia,cobb,13067\n")
    inp = Inputs(feeds_root, maps, f"{root}/fips.csv", landing=f"{root}/landing")
    _write(f"{feeds_root}/ga/a1_per_county.csv",
           "timestamp,EMC,name,n_out,cust_s\n2025-05-01 10:00:00,e1,Fulton,10,100\n")
    ckpt = f"{root}/ckpt"
    run_incremental(spark, inp, out, checkpoint=ckpt)
    h = {r.County: r.SAIDI for r in spark.read.parquet(f"{out}/history").collect()}
    assert h["Fulton"] == 0.025 and h["Cobb"] is None
    # a late file for the same day: the day is recomputed from both files
    _write(f"{feeds_root}/ga/a2_per_county.csv",
           "timestamp,EMC,name,n_out,cust_s\n2025-05-01 10:15:00,e1,Fulton,30,100\n2025-05-01 11:00:00,e2,Cobb,5,50\n")
    run_incremental(spark, inp, out, checkpoint=ckpt)
    hist = spark.read.parquet(f"{out}/history").collect()
    h = {r.County: r.SAIDI for r in hist}
    assert len(hist) == 2
    assert h["Fulton"] == (10 + 30) * 0.25 / 100 and h["Cobb"] == 5 * 0.25 / 50
