"""Generic DataFrame -> DataFrame operators: cleaning, sets, skew, ordered windows."""
