import datetime

import pytest

from footfall import schemas
from footfall.functions import labels
from footfall.params import TaskParams, task_parameters
from footfall.sources.jdbc import load_task_params
from footfall.sources.tables import load_table, relation


def test_parameters_from_json():
    params = TaskParams.from_json(
        '{"startDate": "2024-01-01", "endDate": "2024-01-31", "startAge": "20", "endAge": 40, '
        '"professionals": "it,ops", "cities": "x", "sex": "male", "keywords": "a,,b", "categoryIds": "1,2"}'
    )
    assert params == TaskParams(
        "2024-01-01", "2024-01-31", 20, 40, ("it", "ops"), ("x",), "male", ("a", "b"), ("1", "2")
    )


def test_missing_parameters_switch_filters_off():
    params = TaskParams.from_json('{"sex": "", "cities": null}', today=datetime.date(2024, 3, 1))
    assert params == TaskParams("2024-02-29", "2024-02-29")
    assert TaskParams.from_json(None, today=datetime.date(2024, 3, 1)) == params


def test_task_lookup(spark):
    rows = [(i, f"t{i}", None, None, None, "session", "new", f'{{"sex": "s{i}"}}') for i in range(3)]
    tasks = spark.createDataFrame(rows, schemas.TASK)
    assert load_task_params(tasks, 2).sex == "s2"
    with pytest.raises(LookupError):
        load_task_params(tasks, 9)


def test_tables_by_path_name_and_rows(spark, folder):
    df = relation(spark, [(1,), (2,)], schemas.AD_BLACKLIST, "listed_users")
    df.write.parquet(f"{folder}/t")
    assert load_table(spark, f"{folder}/t").count() == 2
    assert load_table(spark, "listed_users", "table").count() == 2
    df.write.json(f"{folder}/j")
    assert load_table(spark, f"{folder}/j", "json", schemas.AD_BLACKLIST).schema == schemas.AD_BLACKLIST


def test_parameters_of_all_tasks_at_once(spark):
    documents = {
        1: '{"startDate": "2024-01-01", "startAge": "20", "endAge": 40, "cities": "a,,b", "sex": "", "keywords": null}',
        2: "{broken", 3: None, 4: "[1]", 5: '{"startAge": "young", "categoryIds": "1,2"}', 6: "",
    }
    tasks = spark.createDataFrame([(i, None, None, None, None, None, None, d) for i, d in documents.items()], schemas.TASK)
    got = {r.task_id: r for r in task_parameters(tasks).collect()}
    assert [i for i in got if got[i].malformed] == [2, 4]
    one = got[1]
    assert (one.start_date, one.end_date, one.start_age, one.end_age, one.cities, one.sex, one.keywords) == (
        "2024-01-01", None, 20, 40, ["a", "b"], None, None
    )
    assert got[5].start_age is None and got[5].category_ids == ["1", "2"]
    # As the driver-side reader of a single task.
    single = TaskParams.from_json(documents[1], today=datetime.date(2024, 3, 1))
    assert (single.start_age, single.end_age, list(single.cities), single.sex) == (20, 40, one.cities, one.sex)


def test_product_status_of_odd_documents(spark):
    documents = ['{"product_status": 0}', '{"product_status": "0"}', '{"product_status": 1}', "{bad", None, "[]", "{}", '{"product_status": null}']
    frame = spark.createDataFrame([(d,) for d in documents], "d string")
    got = [r[0] for r in frame.select(labels.product_status("d")).collect()]
    assert got[:2] == [labels.K.SELF_OPERATED] * 2 and set(got[2:]) == {labels.K.THIRD_PARTY}
