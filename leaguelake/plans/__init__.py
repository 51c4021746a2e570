"""Tables and questions built from the operators."""
