"""Compare a registered query of the operators with its SQL."""

from ferrocar.llm.queries import QUERIES, SQL
from workload import compare


def difference(spark, folder, name):
    import pandas as pd

    df = QUERIES[name](spark, folder)
    mine = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    cursor = compare.database(folder).execute(SQL[name])
    theirs = pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object)
    return compare.difference(mine, theirs)
