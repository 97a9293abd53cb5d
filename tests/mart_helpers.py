"""Input folders and inline landings shared by the tests."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def make_landing(spark, tables: dict):
    """Landing over inline rows; tables not given are empty."""
    from tidemart.plans.landing import Landing
    from tidemart.sources.rows import landing_rows
    dfs = {}

    def raw(name):
        if name not in dfs:
            dfs[name] = landing_rows(spark, name, tables.get(name, []))
        return dfs[name]
    return Landing(raw)
