import tempfile

from conftest import SF_SMALL, rows
from tagweave.__main__ import main
from tagweave.plans import models as M
from tagweave.plans import testbed as T
from tagweave.plans.runner import plan
from tagweave.sources.store import TagStore


def test_cli_run_matches_plan(spark, capsys):
    root = tempfile.mkdtemp(prefix="tagweave-cli-", dir="/tmp")
    T.base_catalog(spark, SF_SMALL).write.parquet(f"{root}/catalog")
    T.user_cells(spark, SF_SMALL).write.parquet(f"{root}/cells")
    store = TagStore(spark, f"{root}/store")
    store.commit(T.history(spark, SF_SMALL), None)
    assert main(["run", "--model", "age", "--catalog", f"{root}/catalog", "--store", f"{root}/store",
                 "--table", f"{T.USERS_TABLE}={root}/cells"]) == 0
    assert capsys.readouterr().out.strip() == "2"
    want = plan(M.age_model(), T.base_catalog(spark, SF_SMALL), T.history(spark, SF_SMALL),
                {T.USERS_TABLE: T.user_cells(spark, SF_SMALL)})
    assert rows(store.read()) == rows(want)
