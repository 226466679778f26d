from sales_files import facts, write_file
from tallystar.__main__ import main
from tallystar.sources import star_tables as star

ROWS = [("13-06-2010", 1, 1.5, 2, 2.5)]


def test_jobs_in_turn(spark, home, capsys):
    data, lake, mart = (f"{home}/{n}" for n in ("data", "lake", "mart"))
    write_file(data, "a.csv", ROWS)
    main(["create", "--mart", mart])
    assert star.read_fact(spark, mart).count() == 0
    main(["etl", "--input", f"{data}/a.csv", "--lake", lake, "--mart", mart])
    assert "status='loaded'" in capsys.readouterr().out
    main(["reload", "--lake", lake, "--mart", mart])
    assert "skipped" in capsys.readouterr().out
    write_file(data, "b.csv", [("14-6-2010", 3, 3.5, 4, 4.5)])
    main(
        ["ingest", "--input", data, "--lake", lake, "--mart", mart, "--date-format", "d-M-yyyy"]
    )
    assert len(facts(star.read_fact(spark, mart))) == 4
    main(["report", "--mart", mart])
    assert "avg_revenue" in capsys.readouterr().out
    main(["check", "--mart", mart])
    assert "product_dim primary key" in capsys.readouterr().out
    main(["report", "--mart", mart, "--output", f"{home}/out"])
    assert spark.read.parquet(f"{home}/out/top_products").count() == 2
