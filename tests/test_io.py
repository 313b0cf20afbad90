"""CSV inputs as they come: other column orders, more columns, a nameless row number,
values that don't parse."""
import pytest

from custlens.sources import io


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_transactions_are_read_by_name(spark, tmp_path):
    p = write(tmp_path, "t.csv", "more,trx_tm,cny_trx_amt,id,Trx_Cod2_Cd,Trx_Cod1_Cd,Dat_Flg3_Cd,Dat_Flg1_Cd\n"
              "x,2019-05-01 10:00:00,-1.5,a,7,8,C,B\n")
    (r,) = io.read_transactions(spark, p, "train").collect()
    assert (r["id"], r["Dat_Flg1_Cd"], r["cny_trx_amt"], str(r["trx_tm"]), r["split"]) == (
        "a", "B", -1.5, "2019-05-01 10:00:00", "train")


def test_missing_columns_and_bad_values_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="cny_trx_amt"):
        io.read_transactions(spark, write(tmp_path, "a.csv", "id,trx_tm\n1,2019-05-01\n"), "train")
    p = write(tmp_path, "b.csv", "id,Dat_Flg1_Cd,Dat_Flg3_Cd,Trx_Cod1_Cd,Trx_Cod2_Cd,trx_tm,cny_trx_amt\n"
              "1,B,A,1,2,not a time,1.0\n")
    with pytest.raises(Exception, match="trx_tm: not a timestamp"):
        io.read_transactions(spark, p, "train").collect()


def test_importances_with_a_nameless_row_number(spark, tmp_path):
    p = write(tmp_path, "i.csv", ",feature,importance_gain,importance_split,trn_score\n0,age,5170.2,739,0.89\n")
    (r,) = io.read_importances(spark, p).collect()
    assert (r["feature"], r["importance_gain"], r["importance_split"]) == ("age", 5170.2, 739)
