"""Order, facts, scores, pairs and reports of agent sessions as DataFrame functions."""
