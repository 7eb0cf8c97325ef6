"""Plans composed of the operators: layers, marts, training, scoring."""
