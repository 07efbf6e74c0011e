"""The registered toxicity query decides by the whole chain."""
from martcraft.llm import toxicity
from martcraft.llm.queries import QUERIES


def test_overall_verdict_is_the_last_link(spark, monkeypatch):
    made = []
    train = toxicity.train_chain
    monkeypatch.setattr(toxicity, "train_chain", lambda *a, **b: made.append(train(*a, **b)) or made[-1])
    got = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01")
    assert list(made[0].categories) == ["toxic_prose", "toxic_junk", "toxic"]
    assert len(made[0].models[-1].earlier) == 2 and any(made[0].models[-1].earlier)
    types = dict(got.dtypes)
    assert all(types[c] == "boolean" and types[f"p_{c}"] == "double" for c in made[0].categories)
