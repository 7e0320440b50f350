"""Run plans: cleaning / report specs, the batch pipeline, and SQL twins for checking."""
