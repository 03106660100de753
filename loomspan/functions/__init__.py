"""Part of loomspan."""
