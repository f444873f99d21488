import pytest

from tallygauge import approx_quantile, compliance, from_parameters, on, pairs
from tallygauge.spec import Metric, distinct_metrics, split_list


def test_comma_lists_are_split_and_trimmed():
    assert [m.columns for m in on("Mean", " a, b ,c")] == [("a",), ("b",), ("c",)]


def test_commas_in_parentheses_and_quotes_do_not_split():
    assert split_list("a IN (1,2), b = 'x,y', c>3") == ["a IN (1,2)", "b = 'x,y'", "c>3"]


def test_paired_lists_must_match():
    with pytest.raises(ValueError, match="2 entries in the first list but 1"):
        pairs("Correlation", "a,b", "c")
    with pytest.raises(ValueError, match="Compliance"):
        compliance("one", "a=1,b=2")


def test_parameters_expand_to_metrics():
    metrics = from_parameters(
        {
            "CompletenessCol": "a,b",
            "ComplianceCol": "r1,r2",
            "ComplianceLogic": "a=100,b>=200",
            "CorrelationCol": "a",
            "CorrelationLogic": "b",
            "MutualInformationCol": "a",
            "MutualInformationOtheCol": "b",
            "ApproxQuantileCol": "a",
            "quantile": 0.25,
            "PatternMatchCol": "a",
            "PatternMatchPattern": "^x{1,2}$",
        }
    )
    found = [(m.entity, m.instance, m.name) for m in metrics]
    assert found == [
        ("Dataset", "*", "Size"),
        ("Column", "a", "Completeness"),
        ("Column", "b", "Completeness"),
        ("Column", "r1", "Compliance"),
        ("Column", "r2", "Compliance"),
        ("Multicolumn", "a,b", "Correlation"),
        ("Multicolumn", "a,b", "MutualInformation"),
        ("Column", "a", "PatternMatch"),
        ("Column", "a", "ApproxQuantile-0.25"),
    ]
    assert [m.expression for m in metrics if m.kind == "PatternMatch"] == ["^x{1,2}$"]


@pytest.mark.parametrize("unset", [None, "", "false", " False "])
def test_unset_parameters_yield_only_size(unset):
    metrics = from_parameters({"MeanCol": unset, "ComplianceCol": unset, "ComplianceLogic": unset})
    assert [m.name for m in metrics] == ["Size"]


def test_half_a_pair_of_parameters_is_an_error():
    with pytest.raises(ValueError, match="given together"):
        from_parameters({"CorrelationCol": "a"})


def test_wrong_metrics_are_refused():
    with pytest.raises(ValueError, match="unknown metric"):
        Metric("Median", ("a",))
    with pytest.raises(ValueError, match="takes 2"):
        Metric("Correlation", ("a",))
    with pytest.raises(ValueError, match="between 0 and 1"):
        approx_quantile("a", 2)


def test_repeated_metrics_collapse_and_clashes_are_errors():
    assert len(distinct_metrics(on("Mean", "a,a"))) == 1
    with pytest.raises(ValueError, match="share the key"):
        distinct_metrics(compliance("r", "a=1") + compliance("r", "a=2"))


def test_commas_inside_calls_and_quotes_do_not_split():
    text = """coalesce(a, abs(b)) > 1, c > 2, d = "x,y", `e,f` = 'it''s, so', g[1, 2]"""
    assert split_list(text) == ["coalesce(a, abs(b)) > 1", "c > 2", 'd = "x,y"', "`e,f` = 'it''s, so'", "g[1, 2]"]


def test_a_quantile_must_be_given():
    with pytest.raises(ValueError, match="quantile"):
        Metric("ApproxQuantile", ("a",))
