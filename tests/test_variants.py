import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gapwise.operators.assemble import SparseVectorAssembler, assembler
from gapwise.operators.boost import plain_boosted_trees
from gapwise.operators.category import CategoryIndexer
from gapwise.operators.scale import StandardScore
from gapwise.plans import variants

SMALL = {"num_round": 2, "max_depth": 2, "num_workers": 2}


@pytest.mark.parametrize("variant,scored", [("drop_missing", 26), ("imputed", 29), ("sparse", 29)])
def test_variants_run_on_census_records(census, variant, scored, tmp_path):
    trainer = variants.default_trainer(variant, SMALL)
    model = variants.fit(variant, census, variants.CENSUS_ROLES, trainer=trainer, text_out="predicted_income")
    out = model.transform(census)
    assert out.count() == scored
    assert variants.rows_dropped(census, out) == 30 - scored
    assert {r[0] for r in out.select("predicted_income").distinct().collect()} <= {"<=50K", ">50K"}
    assert out.filter("predicted_income = income").count() > scored * 0.7
    if variant == "sparse":
        model.write().overwrite().save(str(tmp_path / "m"))
        again = PipelineModel.load(str(tmp_path / "m"))
        keep = ["fnlwgt", "prediction"]
        assert again.transform(census).select(keep).exceptAll(out.select(keep)).count() == 0
        assert again.transform(census.drop("income")).count() == 30  # rows not labelled yet


def test_standard_scores_of_census_variants(census):
    roles = variants.CENSUS_ROLES
    keep = StandardScore(inputCols=roles.numeric, outputCols=[f"{c}_norm" for c in roles.numeric])
    out = keep.fit(census).transform(census)
    assert out.filter(F.isnan("age_norm")).count() == 2
    zero = keep.copy().setReplacementValue(0.0).fit(census).transform(census)
    assert zero.filter("age_norm = 0").count() >= 2 and zero.filter(F.isnan("age_norm")).count() == 0


def test_feature_vector_has_13_entries(census):
    roles = variants.CENSUS_ROLES
    indexed = [f"{c}_index" for c in roles.categorical]
    stages = [
        CategoryIndexer(inputCols=roles.categorical, outputCols=indexed).fit(census),
        StandardScore(inputCols=roles.numeric, outputCols=[f"{c}_norm" for c in roles.numeric]).fit(census),
        SparseVectorAssembler(inputCols=indexed + [f"{c}_norm" for c in roles.numeric]),
    ]
    rows = variants.apply_stages(census, stages).select("fnlwgt", "features").collect()
    assert {r["features"].size for r in rows} == {13}
    gap = next(r["features"] for r in rows if r["fnlwgt"] == 234721)
    assert sorted(set(range(13)) - set(gap.indices)) == [8, 11]  # age and capital_loss


def test_plain_trees_take_imputed_data_only(census):
    model = variants.fit("imputed", census, variants.CENSUS_ROLES, trainer=plain_boosted_trees(maxIter=2, maxBins=64))
    assert model.transform(census).count() == 29
    with pytest.raises(Exception):
        variants.fit("scaled_keep", census, variants.CENSUS_ROLES, trainer=plain_boosted_trees(maxIter=2, maxBins=64))


def test_unknown_variant(census):
    with pytest.raises(ValueError):
        variants.build("other", census, variants.CENSUS_ROLES)
