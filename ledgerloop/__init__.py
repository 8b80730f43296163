"""Transfer-graph analytics on Spark DataFrames.

Raw transfer rows are normalized and cleaned, turned into an account graph, searched for
closed transfer cycles of bounded length, scored with plain rules and ranked into a case
queue.  Every public function takes and returns DataFrames.  The results are alerts for
review, never verdicts.
"""
