"""Texts that every operator must take."""

ODD = [None, "", " ", "a", "é", "\x00", "x " * 5000, "\t\n \r", "á b"]
