from salesloom.functions import names


def test_table_name():
    assert names.table_name("Metas 2024 (v2)") == "metas_2024_v2"
    assert names.table_name(" Territórios/Segmentos ") == "territorios_segmentos"


def test_column_name():
    cases = {
        "2ª via": "col_2a_via",
        "": "col_",
        "_ingested_at": "ingested_at",
        "Preço  Base (R$)": "preco_base_r",
        "a__b": "a_b",
        7: "col_7",
    }
    assert {label: names.column_name(label) for label in cases} == cases
    assert len(names.column_name("x" * 400)) == 300


def test_header_names():
    assert names.header_names(["x", "x", "y"]) == ["x_0", "x_1", "y"]
    assert names.header_names([None, "a", ""]) == ["_0", "a", "_2"]


def test_unique_columns():
    assert names.unique_columns(["a", "a", "a"]) == ["a", "a_1", "a_2"]
    assert names.unique_columns(["A", "á", "b"]) == ["a", "a_1", "b"]
    collided = names.unique_columns(["a_1", "a", "a"])
    assert collided == ["a_1", "a", "a_2"]


def test_qualified_name():
    assert names.qualified_name(" gold ", "t") == "gold.t"
    assert names.qualified_name(None, "t") == "default.t"
