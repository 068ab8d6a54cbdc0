"""Physical plan patterns shared by the operators."""
