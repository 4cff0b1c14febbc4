"""fluxgrain.plans"""
