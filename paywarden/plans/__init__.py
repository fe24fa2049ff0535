"""Jobs made of the operators: the steps of a run and the run itself."""
