"""The metric layer: model, measures, evaluate, time intelligence."""
