"""The models: silver, gold, decision, batch detectors and the read-side queries."""
