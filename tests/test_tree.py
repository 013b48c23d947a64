"""The fitted tree reproduces the rule table exactly."""

from eligo.operators.rules import D2, decision_table
from eligo.operators.tree import predict, train_tree


def test_tree_reproduces_rule_table(spark):
    for rule_set in (None, D2):
        model = train_tree(spark) if rule_set is None else train_tree(spark, rule_set)
        table = decision_table(spark) if rule_set is None else decision_table(spark, rule_set)
        out = predict(model, table)
        assert out.count() == 12288
        assert out.filter("predicted_label <> expungability").count() == 0
