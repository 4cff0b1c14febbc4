"""fluxgrain.functions"""
